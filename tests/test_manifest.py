"""Versioned corpus folders: emptied shards, flat files, broken runs, conflicts."""

import pytest
from pyspark.sql import functions as F

from quillsieve.functions.reporting import shard_number
from quillsieve.plans.audit import rewrite_live
from quillsieve.sources import manifest, shards

ROWS = [(s, f"{i}", f"text {s} {i}" + (" murder" if s == 1 or (s, i) == (2, 0) else "")) for s in range(4) for i in range(3)]


def corpus(spark, root, flat):
    df = spark.createDataFrame(ROWS, "shard bigint, shuffle_key string, text string")
    if not flat:
        shards.write_shards(df, str(root))
        return
    shards.write_shards(df, f"{root}-folders")
    root.mkdir()
    for s in range(4):
        (part,) = root.with_name(f"{root.name}-folders").glob(f"shard={s}/*.parquet")
        (root / f"shard_{s:05d}.parquet").write_bytes(part.read_bytes())


def live(spark, root, version=None):
    rows = manifest.scan(spark, str(root), "text string", version)
    return sorted((r[0], r[1]) for r in rows.select(shard_number(F.col("_metadata.file_path")), "text").distinct().collect())


def want(published):
    return sorted((s, t) for s, _, t in ROWS if not published or "murder" not in t)


@pytest.mark.parametrize("flat", [False, True])
def test_rewrite_of_a_folder(spark, tmp_path, flat):
    root = tmp_path / "my corpus %41"
    corpus(spark, root, flat)
    assert live(spark, root) == want(False) and manifest.versions(spark, str(root)) == []
    version, dirty = rewrite_live(spark, str(root), group_rows=4)
    assert version == 1 and {tuple(r) for r in dirty.collect()} == {(1, 3, 0), (2, 1, 2)}
    assert live(spark, root) == want(True)
    table = {r.shard: (len(r.files), r.rows) for r in manifest.shards_at(spark, str(root)).collect()}
    assert table == {0: (1, 3), 1: (0, 0), 2: (1, 4), 3: (1, 3)}
    # The first state is still there; a second run changes nothing.
    assert live(spark, root, 0) == want(False)
    assert rewrite_live(spark, str(root))[0] is None
    assert {r.path.split("/")[-1] for r in shards.shard_files(spark, str(root)).collect()} >= {"shard_00000.parquet"} if flat else True
    assert shards.validate_shards(spark, str(root), group_rows=4).count() == 3
    assert shards.scan_shards(spark, str(root)).count() == 10
    # Vacuum removes what no version lists, and nothing young.
    assert manifest.vacuum(spark, str(root)) == 0
    assert manifest.vacuum(spark, str(root), min_age_hours=0) == 2
    assert live(spark, root) == want(True)


@pytest.mark.parametrize("flat", [False, True])
def test_a_run_that_dies_changes_nothing(spark, tmp_path, flat, monkeypatch):
    root = tmp_path / "c"
    corpus(spark, root, flat)

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            rewrite_live(spark, str(root), group_rows=4)
    assert (root / manifest.DATA).exists()
    assert live(spark, root) == want(False)
    assert rewrite_live(spark, str(root), group_rows=4)[0] == 1
    assert live(spark, root) == want(True)


def test_all_shards_emptied(spark, tmp_path):
    root = str(tmp_path / "c")
    df = spark.createDataFrame([(0, "1", "murder"), (1, "1", "suicide")], "shard bigint, shuffle_key string, text string")
    shards.write_shards(df, root)
    assert rewrite_live(spark, root)[0] == 1
    assert live(spark, root) == [] and shards.scan_shards(spark, root).collect() == []
    assert {r.rows for r in manifest.shards_at(spark, root).collect()} == {0}
    assert manifest.restore(spark, root, 0) == 2 and len(live(spark, root)) == 2


def test_changes_at_the_same_time(spark, tmp_path):
    root = str(tmp_path / "c")
    corpus(spark, tmp_path / "c", False)
    kind = "shard bigint, shuffle_key string, text string"

    def change(shard, then=None):
        rows = spark.createDataFrame([(shard, "1", f"new {shard}")], kind)

        def write(rows, folder):
            shards.write_shards(rows, folder)
            if then:
                then()

        return manifest.replace_shards(spark, root, rows, rows.select("shard"), write)

    # Another shard is replaced in between: both changes hold.
    assert change(0, lambda: change(3)) == 2
    got = live(spark, root)
    assert (0, "new 0") in got and (3, "new 3") in got and len(got) == 8
    # The same shard: the later change gives up.
    with pytest.raises(manifest.Conflict):
        change(2, lambda: change(2))
    assert (2, "new 2") in live(spark, root)
    # A new shard is added.
    change(9)
    assert (9, "new 9") in live(spark, root)
    with pytest.raises(ValueError):
        manifest.shards_at(spark, root, 77)
