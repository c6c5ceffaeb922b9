"""Versioned list of a corpus folder's live shard files.

Version n of a folder is the small table ``_manifest/<n>/shards``: a row for every
shard with its files (paths below the folder), rows and bytes. A shard that lost
all its rows keeps a row without files, a tombstone. A change writes its files
to a folder of its own below ``_versions``, which readers of the whole folder
skip, then the new list, and becomes
visible by one rename of that list; until then, and if the run dies, readers see
the old files. A folder without a manifest, ``shard=N`` folders or
``shard_N.parquet`` files side by side, is version 0: whatever lies in it.

Readers and writers of a managed folder go through this module, since the files
of older versions stay until ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.reporting import shard_number
from ..runtime import filesystem_of, materialize, rename_new

FOLDER = "_manifest"
DATA = "_versions"
SCHEMA = "shard bigint, files array<string>, rows bigint, bytes bigint"
BATCHES = "batch string, version bigint"
# Tries of a change that others overtake.
TRIES = 20


class Conflict(Exception):
    """Another change replaced one of the same shards first."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending; none for an unmanaged folder."""
    filesystem, path = filesystem_of(spark, f"{root}/{FOLDER}")
    if not filesystem.exists(path):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(path)]
    return sorted(int(name) for name in names if name.isdigit())


def _below(root: str, spark: SparkSession) -> Callable[[Column], Column]:
    """Expression for a file's path relative to ``root``."""
    filesystem, path = filesystem_of(spark, root)
    whole = filesystem.makeQualified(path).toString().rstrip("/") + "/"
    return lambda file: F.substring(file, F.lit(len(whole) + 1), F.length(file))


def _listed(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """file (relative), bytes of the Parquet files below ``folder``; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return found.select(_below(root, spark)(F.col("path")).alias("file"), F.col("length").alias("bytes"))


def _counted(spark: SparkSession, files: list[str], root: str) -> DataFrame:
    """shard and rows of ``files``, from their footers."""
    rows = spark.read.schema("text string").parquet(*(f"{root}/{f}" for f in files))
    return rows.groupBy(shard_number(F.col("_metadata.file_path")).alias("shard")).agg(F.count(F.lit(1)).alias("rows"))


def _entries(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """Manifest rows for listed files."""
    by_shard = listed.groupBy(shard_number(F.col("file")).alias("shard")).agg(
        F.array_sort(F.collect_list("file")).alias("files"), F.sum("bytes").cast("bigint").alias("bytes")
    )
    names = [r.file for r in listed.select("file").collect()]
    if not names:
        return spark.createDataFrame([], SCHEMA)
    counted = by_shard.join(_counted(spark, names, root), "shard", "left")
    return counted.select("shard", "files", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes")


def shards_at(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """shard, files, rows, bytes of a version (the newest by default), tombstones included."""
    root = root.rstrip("/")
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else 0
    if version:
        if version not in known:
            raise ValueError(f"{root} has no version {version}")
        return spark.read.schema(SCHEMA).parquet(f"{root}/{FOLDER}/{version:012d}/shards")
    filesystem, path = filesystem_of(spark, root)
    if not filesystem.exists(path):
        return spark.createDataFrame([], SCHEMA)
    return _entries(spark, root, materialize(_listed(spark, root, root), "listed"))


def live_files(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """Paths of a managed folder's live files, one or a few for each shard; just ``root`` for an unmanaged one."""
    root = root.rstrip("/")
    if version is None and not versions(spark, root):
        return [root]
    rows = shards_at(spark, root, version).select(F.explode("files").alias("file")).orderBy("file")
    return [f"{root}/{r.file}" for r in rows.toLocalIterator()]


def scan(spark: SparkSession, root: str, schema: str, version: int | None = None, **options: str) -> DataFrame:
    """Rows of the live files with the columns of ``schema``; no rows if every shard is empty."""
    files = live_files(spark, root, version)
    reader = spark.read.schema(schema).options(**options)
    if not files:
        # A listing without files keeps the file's metadata columns.
        filesystem, path = filesystem_of(spark, f"{root}/{FOLDER}/none")
        filesystem.mkdirs(path)
        files = [path.toString()]
    return reader.parquet(*files)


def _publish(spark: SparkSession, root: str, entries: DataFrame, version: int, batches: DataFrame) -> bool:
    """Write a version's lists and rename them into place; False if that version exists by now."""
    staged = f"{root}/{FOLDER}/staged-{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(f"{staged}/shards")
    batches.coalesce(1).write.parquet(f"{staged}/batches")
    if rename_new(spark, staged, f"{root}/{FOLDER}/{version:012d}"):
        return True
    filesystem, path = filesystem_of(spark, staged)
    filesystem.delete(path, True)
    return False


def batches(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """batch, version: the named changes that a version (the newest by default) holds."""
    known = versions(spark, root)
    version = version if version is not None else (known or [0])[-1]
    if not version:
        return spark.createDataFrame([], BATCHES)
    return spark.read.schema(BATCHES).parquet(f"{root.rstrip('/')}/{FOLDER}/{version:012d}/batches")


def _same(one: DataFrame, two: DataFrame, shards: DataFrame) -> bool:
    """Whether two versions agree on ``shards``."""
    plain = [d.select("shard", F.concat_ws("\n", "files").alias("files")).join(shards, "shard", "left_semi") for d in (one, two)]
    return plain[0].exceptAll(plain[1]).isEmpty() and plain[1].exceptAll(plain[0]).isEmpty()


def replace_shards(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    touched: DataFrame,
    write: Callable[[DataFrame, str], None],
    batch: str | None = None,
) -> int:
    """Publish ``rows`` as the new content of the shards in ``touched`` (shard); returns the new version.

    ``write`` writes rows as ``shard=N`` folders below a given path. A touched
    shard without rows becomes a tombstone; shards of ``rows`` that are new are
    added. Others stay as they are. If another change came first, this one
    follows it unless both replace a shard (Conflict). A run that dies leaves the
    former version in force, and may be repeated. A change with a ``batch`` name
    takes place once: if the folder holds it already, nothing is done.
    """
    root = root.rstrip("/")
    base = (versions(spark, root) or [0])[-1]

    def held(version: int) -> bool:
        return batch is not None and not batches(spark, root, version).where(F.col("batch") == batch).isEmpty()

    if held(base):
        return base
    before = materialize(shards_at(spark, root, base), "before")
    folder = f"{root}/{DATA}/{uuid.uuid4().hex}"
    write(rows, folder)
    fresh = materialize(_entries(spark, root, materialize(_listed(spark, root, folder), "listed")), "fresh")
    shards = materialize(touched.select(F.col("shard").cast("bigint")).union(fresh.select("shard")).distinct(), "touched")
    gone = shards.join(fresh, "shard", "left_anti").select(
        "shard", F.array().cast("array<string>").alias("files"),
        F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("bytes"),
    )
    for _ in range(TRIES):
        newest = (versions(spark, root) or [0])[-1]
        current = before if newest == base else shards_at(spark, root, newest)
        if newest != base and not _same(before, current, shards):
            raise Conflict(f"version {newest} of {root} replaced the same shards")
        if newest != base and held(newest):
            return newest
        kept = current.join(shards, "shard", "left_anti")
        names = batches(spark, root, newest)
        if batch is not None:
            names = names.union(spark.createDataFrame([(batch, newest + 1)], BATCHES))
        if _publish(spark, root, kept.unionByName(fresh).unionByName(gone), newest + 1, names):
            return newest + 1
    raise Conflict(f"{root} changes faster than this change can follow")


def restore(spark: SparkSession, root: str, version: int) -> int:
    """Make an earlier version the newest again, as long as ``vacuum`` has left its files."""
    root = root.rstrip("/")
    newest = (versions(spark, root) or [0])[-1]
    if not _publish(spark, root, shards_at(spark, root, version), newest + 1, batches(spark, root, version)):
        raise Conflict(f"{root} has changed")
    return newest + 1


def vacuum(spark: SparkSession, root: str, keep: int = 1, min_age_hours: float = 24) -> int:
    """Delete shard files that none of the last ``keep`` versions lists; returns how many.

    Files younger than ``min_age_hours`` may belong to a change that is still
    being written, and stay.
    """
    root = root.rstrip("/")
    known = versions(spark, root)
    if not known or keep < 1:
        return 0
    used = [shards_at(spark, root, v).select(F.explode("files").alias("file")) for v in known[-keep:]]
    listed = used[0]
    for more in used[1:]:
        listed = listed.union(more)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    found = reader.load([root, f"{root}/{DATA}"])
    old = F.col("modificationTime") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(min_age_hours * 3600))
    files = found.where(old).select(_below(root, spark)(F.col("path")).alias("file"))
    removed = 0
    for row in materialize(files.join(listed, "file", "left_anti"), "unused").toLocalIterator():
        filesystem, path = filesystem_of(spark, f"{root}/{row.file}")
        removed += bool(filesystem.delete(path, False))
    for version in known[:-keep]:
        filesystem, path = filesystem_of(spark, f"{root}/{FOLDER}/{version:012d}")
        filesystem.delete(path, True)
    return removed
