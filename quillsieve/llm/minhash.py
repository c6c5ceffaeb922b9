"""Near-duplicate groups by SetSketch registers.

Each document's distinct word shingles become ``REGISTERS`` registers: the
smallest of the shingles' exponential variates, as a truncated logarithm to the
base ``BASE``. Registers merge by maximum and agree the more often the more
alike two sets are. Bands of ``ROWS`` registers name buckets. The members of a
bucket are compared with its first one; the likelihood of the register order (above, below,
equal), with the known set sizes, estimates the similarity, and pairs that can
reach the threshold are verified on whole sets.

Rows with equal sets form a class (a node of the graph), and only one of them is
compared. What is still apart within a bucket, its first one aside, meets by an
exact prefix filter:
shingles are ordered by rarity, and two sets of sizes a and b can only be linked
if their first a - o + 1 and b - o + 1 shingles share one, where o is the overlap
that the threshold asks for. Shingles that a single component holds come first:
they fill places in a prefix, but no pair across components meets in them. So
neither a large component nor a family of templated texts below the threshold is
paired up; only sets that meet in a rare shingle and a bucket are compared. A set
outside the largest component of a shingle first meets a few of its members there;
only sets that are apart after some such rounds meet all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.components import components
from quillsieve.llm.words import mix, read_words, rolling
from quillsieve.runtime import materialize

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100  # linked: 100 * intersection >= 75 * union
REGISTERS = 128
ROWS = 4
BASE = 1.02
TOP = 65534
# Below the threshold by five standard errors of an estimate from 128 registers.
SLACK = 0.2
# Set sizes of a class differ by this factor at most.
SIZE_STEP = 1.02
# What sets of a prefix meet at: a shingle and their size classes.
KEY = ["shingle", "small", "large"]
# Pairs of one document that one salted key takes.
SALT_PAIRS = 256
# Rounds in which sets apart meet some of the large component at a key, before all pairs that are left.
STAR_ROUNDS = 2
# Members of that component that a set meets in the first round; each later one has STAR_GROWTH times as many.
STAR_HEADS = 16
STAR_GROWTH = 16


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted, one text after the other, and their counts."""
    words = read_words(texts)
    hashes = words.hashes(fold=True)
    windows = rolling(hashes, width)
    sets = []
    for low, count in zip(words.first.tolist(), words.sizes.tolist()):
        if count >= width:
            sets.append(np.unique(windows[low : low + count - width + 1]))
        else:  # the whole sequence, if any
            sets.append(rolling(hashes[low : low + count], count) if count else hashes[:0])
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate(sets) if sets else hashes, counts


def sketches(flat: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Registers of consecutive non-empty sets, one row for each."""
    heads = np.cumsum(counts) - counts
    seeds = mix(np.arange(1, 2 * registers + 1, dtype=np.uint64))
    least = np.empty((registers, len(counts)), np.uint64)
    for j in range(registers):
        least[j] = np.minimum.reduceat(flat * (seeds[2 * j] | np.uint64(1)) + seeds[2 * j + 1], heads)
    variate = -np.log1p(-(least.T.astype(np.float64) + 0.5) * 2.0**-64 * (1 - 2.0**-53))
    return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def band_keys(registers: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of the values of each ``rows`` consecutive registers and their band."""
    parts = registers.reshape(len(registers), -1, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for r in range(rows):
        key = mix(key * np.uint64(65537) + parts[:, :, r] + np.uint64(1))
    return key.view(np.int64)


def estimate(above: np.ndarray, below: np.ndarray, equal: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of greatest likelihood, from register comparisons and set sizes, in steps of 0.01."""
    u = (left / (left + right))[:, None]
    v = 1 - u
    grid = np.minimum(np.arange(101) / 100, np.minimum(u / v, v / u))

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    score = (
        above[:, None] * np.log(np.maximum(up, tiny))
        + below[:, None] * np.log(np.maximum(down, tiny))
        + equal[:, None] * np.log(np.maximum(1 - up - down, tiny))
    )
    return grid[np.arange(len(grid)), score.argmax(axis=1)]


def sketch_documents(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, content (see _content), n_shingles, and for non-empty sets d1, d2 (digest of the set), registers."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("content", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
            ("registers", pa.binary()),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, "text"):
            flat, counts = shingle_sets(part.column("text"), width)
            full = counts > 0
            digests = np.zeros((2, len(counts)), np.int64)
            registers = np.zeros((len(counts), REGISTERS), np.uint16)
            if full.any():
                heads = (np.cumsum(counts) - counts)[full]
                digests[0, full] = np.add.reduceat(mix(flat), heads).view(np.int64)
                digests[1, full] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), heads).view(np.int64)
                registers[full] = sketches(flat, counts[full])
            ends = np.cumsum(np.full(len(counts), REGISTERS))
            yield arrow.batch(
                schema, part.column("doc_id"), part.column("content"), counts, digests[0], digests[1],
                arrow.binaries(registers.reshape(-1), ends),
            )

    kind = "doc_id bigint, content bigint, n_shingles bigint, d1 bigint, d2 bigint, registers binary"
    return docs.select("doc_id", _content(), "text").mapInArrow(sketch, kind)


def _content() -> Column:
    """Tells rows with one doc_id apart by their text."""
    return F.xxhash64("doc_id", "text").alias("content")


def _banded(heads: DataFrame) -> DataFrame:
    """node, n_shingles and one row for each ``band`` of every head."""
    schema = pa.schema([("node", pa.int64()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = band_keys(np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS))
            places = pa.array(np.arange(0, bands.size + 1, bands.shape[1]), pa.int32())
            lists = pa.ListArray.from_arrays(places, bands.reshape(-1))
            yield arrow.batch(schema, batch.column("node"), batch.column("n_shingles"), lists)

    rows = heads.select("node", "n_shingles", "registers")
    cuts = rows.mapInArrow(cut, "node bigint, n_shingles bigint, bands array<bigint>")
    return cuts.select("node", "n_shingles", F.explode("bands").alias("band"))


def _can_link(one: np.ndarray, two: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether registers and set sizes allow the threshold, pair by pair."""
    above, below = (one > two).sum(axis=1), (one < two).sum(axis=1)
    near = estimate(above, below, REGISTERS - above - below, left, right) >= NUMERATOR / DENOMINATOR - SLACK
    return near & (DENOMINATOR * np.minimum(left, right) >= NUMERATOR * np.maximum(left, right))


def _with_sides(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the columns of ``facts`` (node, ...) for either side, named ``_a`` and ``_b``.

    A node in many pairs is copied to salted keys, so that its pairs do not meet in one task.
    """
    joined = pairs
    ends = F.explode(F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("end")) for c in ("a", "b"))))
    counted = pairs.select(ends.alias("_")).select("_.*").groupBy("side", "end")
    counted = counted.agg(F.ceil(F.count(F.lit(1)) / SALT_PAIRS).cast("int").alias("_salts"))
    many = materialize(counted.where("_salts > 1"), "salted")
    for side, other in ("b", "a"), ("a", "b"):
        salted = many.where(F.col("side") == side).select(F.col("end").alias(side), "_salts")
        salts = F.coalesce("_salts", F.lit(1))
        named = facts.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in facts.columns if c != "node"))
        named = named.join(salted, side, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
        dealt = joined.join(salted, side, "left").withColumn("_salt", F.pmod(F.xxhash64(other), salts).cast("int")).drop("_salts")
        joined = dealt.join(named, [side, "_salt"]).drop("_salt")
    return joined


def _judged(batch: pa.RecordBatch) -> pa.Array:
    """Whether the pairs share a bucket and their registers and sizes allow the threshold."""
    one, two = (
        np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS).astype(np.int64)
        for c in ("registers_a", "registers_b")
    )
    left, right = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_shingles_a", "n_shingles_b"))
    near = _can_link(one, two, left, right)
    return pa.array(near & (one.reshape(len(one), -1, ROWS) == two.reshape(len(two), -1, ROWS)).all(axis=2).any(axis=1))


def _near(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs (a, b) that share a bucket and whose registers and sizes allow the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _judged(batch)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in ("a", "b")], schema=schema)

    sided = _with_sides(pairs, heads.select("node", "registers", "n_shingles"))
    return sided.mapInArrow(judge, "a bigint, b bigint")


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored node, n_shingles, registers and text of ``wanted`` (stored; with doc_id and content)."""
    found = docs.select("doc_id", _content(), "text").join(wanted, ["doc_id", "content"])
    found = materialize(found.select("node", "n_shingles", "registers", "text"), "texts")
    # Only copies of a row with its doc_id are found more than once.
    return found if found.count() == wanted.count() else materialize(found.dropDuplicates(["node"]), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) that are linked, decided on whole sets.

    Where ``texts`` has registers and sizes, too, pairs that _near would drop are dropped first.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    judged = "registers" in texts.columns

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if judged:
                whole = whole.filter(_judged(whole))
            for batch in arrow.slices(iter([whole]), "text_b"):
                names = batch.column("a").to_pylist()
                distinct = {a: n for n, a in enumerate(dict.fromkeys(names))}
                firsts = [names.index(a) for a in distinct]
                flat, counts = shingle_sets(batch.column("text_a").take(pa.array(firsts)), width)
                sets = np.split(flat, np.cumsum(counts)[:-1])
                flat, counts = shingle_sets(batch.column("text_b"), width)
                linked = []
                for a, other in zip(names, np.split(flat, np.cumsum(counts)[:-1])):
                    own = sets[distinct[a]]
                    both = len(own) + len(other) - len(np.union1d(own, other))
                    linked.append(DENOMINATOR * both >= NUMERATOR * (len(own) + len(other) - both))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).filter(pa.array(linked)) for c in ("a", "b")], schema=schema
                )

    return _with_sides(pairs, texts).mapInArrow(check, "a bigint, b bigint")


def _linked(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Stored links among ``pairs`` (stored, distinct); texts are read for the near ones only."""
    near = materialize(_near(pairs, texts), "near")
    return materialize(_verified(near, texts.select("node", "text"), width), "links")


def _placed(rows: DataFrame, parts: DataFrame, node: str = "node", component: str = "component") -> DataFrame:
    """``rows`` with the component of ``node``; one without links is its own."""
    named = parts.select(F.col("id").alias(node), F.col("component").alias(component))
    return rows.join(named, node, "left").withColumn(component, F.coalesce(component, node))


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Stored components ``parts`` once the stored ``links`` between them are added.

    Only the graph of the components that are linked is walked, not the links within them.
    """
    ends = _placed(_placed(links, parts, "a", "_one"), parts, "b", "_two")
    ends = materialize(ends.select("_one", "_two").where("_one <> _two"), "ends")
    joined = components(ends, "_one", "_two")
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("_to"))
    known = parts.join(moved, "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    # Nodes that had no link so far.
    return materialize(known.unionByName(joined.join(parts, "id", "left_anti")), "parts")


def _open_buckets(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Stored ``members`` of buckets that hold several components beside their first node, with their ``component``.

    The first node has been compared with all others.
    """
    others = members.where("node <> first").select("band", "node", "n_shingles")
    placed = materialize(_placed(others, parts), "placed")
    spread = placed.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    spread = materialize(spread.where("_low < _high").select("band"), "open")
    return materialize(placed.join(spread, "band"), "apart")


def least_overlap(one: Column, two: Column) -> Column:
    """Shingles that linked sets of these sizes share at least: ceil(NUMERATOR * (one + two) / (NUMERATOR + DENOMINATOR))."""
    whole = NUMERATOR + DENOMINATOR
    return F.call_function("div", (one + two) * NUMERATOR + (whole - 1), F.lit(whole))


def size_class(size: Column) -> Column:
    return F.floor(F.ln(size) / float(np.log(SIZE_STEP))).cast("int")


def _partners(apart: DataFrame) -> DataFrame:
    """node and ``partners``, the size classes of sets that it could be linked with in one of its buckets."""
    sized = apart.withColumn("class", size_class(F.col("n_shingles")))
    # One entry for each size class of a bucket.
    present = materialize(sized.groupBy("band").agg(F.collect_set("class").alias("classes")), "classes")
    farthest = int(np.ceil(np.log(DENOMINATOR / NUMERATOR) / np.log(SIZE_STEP))) + 1
    fits = sized.join(present, "band").select(
        "node", F.array_sort(F.filter("classes", lambda c: F.abs(c - F.col("class")) <= farthest)).alias("classes")
    )
    return fits.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("classes"))).alias("partners"))


def _prefixes(apart: DataFrame, nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Stored shingles of the prefixes: shingle, small, large (size classes), node, component, n_shingles, place.

    ``nodes`` (node, component, n_shingles) has each node of ``apart`` once, ``texts`` (node, text) no other.
    """
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, "text"):
            flat, counts = shingle_sets(part.column("text"), width)
            ends = np.concatenate([[0], np.cumsum(counts)])
            yield arrow.batch(
                schema, part.column("node"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
            )

    sets = texts.select("node", "text").mapInArrow(read, "node bigint, shingles array<bigint>")
    each = sets.join(nodes, "node").select("node", "component", "n_shingles", F.explode("shingles").alias("shingle"))
    each = materialize(each, "shingles")
    # Shingles of one component come first in the order; the others by their number of sets.
    common = each.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("sets"), F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    common = materialize(common.where("_low < _high").select("shingle", "sets"), "common")
    shared = materialize(each.join(common, "shingle"), "shared")
    size = F.col("n_shingles")
    own = Window.partitionBy("node")
    placed = shared.withColumn("place", size - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("sets", "shingle")) - 1)
    longest = size - F.call_function("div", size * NUMERATOR + (DENOMINATOR - 1), F.lit(DENOMINATOR)) + 1
    placed = placed.where(F.col("place") < longest)
    # The partner's size is at least the smallest of its class, and no less than the threshold allows.
    fewest = F.call_function("div", size * NUMERATOR + (DENOMINATOR - 1), F.lit(DENOMINATOR))

    def reaches(partner: Column) -> Column:
        least = F.greatest(F.floor(F.pow(F.lit(SIZE_STEP), partner)).cast("bigint"), fewest)
        return F.col("place") <= size - least_overlap(size, least)

    met = placed.join(materialize(_partners(apart), "partners"), "node")
    met = met.withColumn("partner", F.explode(F.filter("partners", reaches)))
    kind = size_class(size)
    return materialize(
        met.select(
            "shingle", F.least(kind, "partner").alias("small"), F.greatest(kind, "partner").alias("large"),
            "node", "component", "n_shingles", "place",
        ),
        "prefixes",
    )


def _meeting(prefixes: DataFrame, parts: DataFrame) -> DataFrame:
    """Stored ``prefixes`` at keys that hold several components, with ``main`` (the one that holds most) and its number of sets."""
    placed = _placed(prefixes.drop("component"), parts)
    sizes = placed.groupBy(*KEY, "component").agg(F.count(F.lit(1)).alias("n"))
    facts = sizes.groupBy(*KEY).agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("components"))
    facts = facts.where("components > 1").select(*KEY, F.col("top.component").alias("main"), F.col("top.n").alias("main_sets"))
    return materialize(placed.join(materialize(facts, "keys"), KEY), "meeting")


def _fits(x: str, y: str) -> Column:
    """Whether sizes and places of two sets that meet allow the threshold."""
    size_x, size_y = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    overlap = least_overlap(size_x, size_y)
    left_over = F.least(size_x - F.col(f"{x}.place"), size_y - F.col(f"{y}.place"))
    return (left_over >= overlap) & (F.least(size_x, size_y) >= overlap)


def _stars(meeting: DataFrame, heads: int, seed: int) -> DataFrame:
    """Pairs (a, b) of each set outside a key's main component with about ``heads`` of its members.

    The members are dealt to slots, and the set meets those of one slot.
    """
    slots = F.ceil(F.col("main_sets") / heads)
    dealt = meeting.withColumn("slot", F.pmod(F.xxhash64("node", F.lit(seed)), slots))
    x = dealt.where("component <> main").alias("x")
    y = dealt.where("component = main").alias("y")
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*KEY, "slot")] + [_fits("x", "y")])
    met = met.groupBy("x.node", "x.main", F.col("y.node").alias("head")).agg(F.count(F.lit(1)).alias("shared"))
    ranked = Window.partitionBy("node", "main").orderBy(F.desc("shared"), "head")
    likely = met.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= heads)
    return likely.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def _across(meeting: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that meet in a prefix and whose sizes and places allow the threshold.

    At each key the sets outside the component that holds most of it meet the
    others, so that a large component is not paired with itself.
    """
    rows = meeting.select(*KEY, "node", "component", "n_shingles", "place", "main")
    left = rows.where("component <> main").alias("x")
    right = rows.alias("y")
    met = left.join(right, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in KEY] + [
        F.col("x.component") != F.col("y.component"), _fits("x", "y"),
    ])
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _link_apart(apart: DataFrame, parts: DataFrame, tried: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Components once all linked pairs of ``apart`` that share a bucket are linked, too."""
    nodes = materialize(apart.select("node", "component", "n_shingles").distinct(), "apart-nodes")
    texts = materialize(texts.join(nodes.select("node"), "node", "left_semi"), "apart-texts")
    prefixes = _prefixes(apart, nodes, texts, width)
    for turn in range(STAR_ROUNDS + 1):
        meeting = _meeting(prefixes, parts)
        pairs = _stars(meeting, STAR_HEADS * STAR_GROWTH**turn, turn) if turn < STAR_ROUNDS else _across(meeting)
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        # Sets that meet in a prefix are mostly near, so texts come along with the registers.
        more = materialize(_verified(pairs, texts, width), "links")
        if not more.isEmpty():
            parts = _merged(parts, more)
        tried = tried.unionByName(pairs)
    return parts


def near_duplicates(docs: DataFrame, *, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words ignore the case of A-Z. A null or wordless text has no shingles and is
    its own component; so is a row without doc_id (component_id null, kept true).
    Rows with equal doc_id are judged by their own text: copies get the same
    component, different texts are not connected by their doc_id. Other columns
    are dropped.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = materialize(sketch_documents(own, width), "sketches")
    digest = ["d1", "d2", "n_shingles"]
    full = known.where("n_shingles > 0 and doc_id is not null")
    # The class's smallest row stands for it; stored, so that the number of a node stays its own.
    first = full.groupBy(*digest).agg(F.min(F.struct("doc_id", "content", "registers")).alias("head"))
    heads = materialize(first.select(*digest, "head.*", F.monotonically_increasing_id().alias("node")), "heads")

    banded = materialize(_banded(heads), "bands")
    ends = banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("_last"))
    ends = ends.where("first < _last").select("band", "first")
    # Stored right after the join, so that a large bucket's partition can be split.
    members = materialize(banded.join(materialize(ends, "ends"), "band"), "buckets")
    nodes = materialize(members.select("node").distinct(), "nodes")
    wanted = materialize(nodes.join(heads.select("node", "doc_id", "content", "n_shingles", "registers"), "node"), "wanted")
    texts = _texts_of(wanted, own)
    stars = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    stars = materialize(stars.distinct(), "stars")
    parts = components(_linked(stars, texts, width))
    apart = _open_buckets(members, parts)
    if not apart.isEmpty():
        parts = _link_apart(apart, parts, stars, texts, width)

    grouped = heads.select(*digest, "doc_id", "node").join(parts.withColumnRenamed("id", "node"), "node", "left")
    grouped = materialize(grouped.withColumn("component", F.coalesce("component", "node")), "grouped")
    least = materialize(grouped.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = grouped.join(least, "component").select(*digest, "component_id")
    answer = known.select("doc_id", *digest).join(materialize(named, "named"), digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return answer.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
