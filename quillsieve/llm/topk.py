"""Exact top-k by inner product over a pivot-distance index.

Vectors of integers get one more component, so that all have the length of the
longest; for a query with a zero there, distance falls as the inner product
rises: distance^2 = longest^2 + |query|^2 - 2 * product. Each vector is keyed by
its nearest pivot and its distance to it, and cut into annuli of equal width;
crowded annuli are split into parts. A query that needs products of at least t
looks at distances up to r(t), and by the triangle inequality only at annuli
between D - r and D + r of a pivot at distance D. It begins with the annuli
around itself, goes on to the nearest pivots, and ends with all pivots; the
tenth best score found so far shrinks r each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillsieve.llm import arrow
from quillsieve.runtime import materialize

PIVOTS = 32
# Vectors that pivots and the annuli's width are fitted to.
SAMPLE = 4096
# Rows an annulus holds on average, and a part of one at most (as far as a hash spreads evenly).
RING_ROWS = 1024
PART_ROWS = 4096
# Queries that meet a part in one task.
QUERY_ROWS = 4096
NEAR_PIVOTS = 4


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v (floor(scale * x) of every component); rows with missing or non-finite parts are left out."""
    x = F.col("embedding")
    usable = F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & usable)
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products; exact while they fit a 64-bit integer."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if top < 2**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


@dataclass
class Index:
    width: int  # components
    longest: float  # squared length of the longest vector
    pivots: np.ndarray
    step: float  # width of an annulus
    table: DataFrame | None = None  # vec_id, v, cell, ring, part
    parts: DataFrame | None = None  # cell, ring, parts
    reach: np.ndarray | None = None  # smallest and largest ring of each cell

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        plain = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(self.longest - (plain * plain).sum(axis=1), 0))
        return np.column_stack([plain, rest])

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))


def _fit_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """A few rounds of k-means from evenly spaced sample rows."""
    points = np.unique(points, axis=0)
    pivots = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)]
    for _ in range(8):
        square = (pivots**2).sum(axis=1) - 2 * points @ pivots.T
        own = square.argmin(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(pivots))
        pivots = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], pivots)
    return pivots


def build_index(
    vectors: DataFrame, *, pivots: int = PIVOTS, sample: int = SAMPLE, ring_rows: int = RING_ROWS, part_rows: int = PART_ROWS
) -> Index | None:
    """Index of stored ``vectors`` (vec_id, v). Pivots are fitted to ``sample`` rows chosen by a hash; every row is indexed."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    count, width, longest = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(square)).first()
    if not count:
        return None
    width = max(1, width)
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    index = Index(width, longest, np.zeros((0, width + 1)), 1.0)
    points = index.lifted(matrix(drawn.column("v"), width))
    index.pivots = _fit_pivots(points, pivots)
    near = index.distances(points).min(axis=1)
    low, high = np.quantile(near, [0.01, 0.99])
    rings = max(8, count // (len(index.pivots) * ring_rows))
    index.step = max(float(high - low) / rings, 1e-6 * (1 + longest**0.5))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = index.distances(index.lifted(matrix(batch.column("v"), width)))
            cell = distance.argmin(axis=1)
            ring = np.floor(distance.min(axis=1) / index.step).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(ring)], ["vec_id", "v", "cell", "ring"])

    keyed = materialize(vectors.mapInArrow(key, "vec_id bigint, v array<bigint>, cell bigint, ring bigint"), "keyed")
    counts = keyed.groupBy("cell", "ring").count()
    index.parts = materialize(
        counts.select("cell", "ring", F.ceil(F.col("count") / part_rows).cast("bigint").alias("parts")), "rings"
    )
    index.table = keyed.join(index.parts, ["cell", "ring"]).select(
        "vec_id", "v", "cell", "ring", F.pmod(F.xxhash64("vec_id"), "parts").alias("part")
    )
    # One row for each pivot.
    ends = {r["cell"]: (r["low"], r["high"]) for r in index.parts.groupBy("cell").agg(F.min("ring").alias("low"), F.max("ring").alias("high")).collect()}
    index.reach = np.array([ends.get(c, (0, -1)) for c in range(len(index.pivots))])
    return index


def _annuli(queries: DataFrame, index: Index, stage: int) -> DataFrame:
    """query_id, v, least, least_id and the (cell, ring) pairs of a stage that can hold a better vector."""
    schema = pa.schema(
        [("query_id", pa.int64()), ("v", pa.list_(pa.int64())), ("least", pa.int64()), ("least_id", pa.int64()), ("cell", pa.int64()), ("ring", pa.int64())]
    )
    # Without the driver's tables, which tasks can't hold.
    plain = Index(index.width, index.longest, index.pivots, index.step, reach=index.reach)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                yield from chosen(part)

    def chosen(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = matrix(batch.column("v"), plain.width).astype(np.float64)
        distance = plain.distances(np.column_stack([vectors, np.zeros(len(vectors))]))
        low, high = plain.reach[:, 0], plain.reach[:, 1]
        if stage == 0:
            at = np.clip(np.floor(distance / plain.step).astype(np.int64), low, high)
            first, last = np.maximum(at - 1, low), np.minimum(at + 1, high)
            allowed = 1
        else:
            least = batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
            square = plain.longest + (vectors**2).sum(axis=1) - 2 * least
            # Rounding of distances is far below this margin.
            radius = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(square, 0)) + 1e-6 * (1 + plain.longest**0.5))
            first = np.maximum(np.floor(np.maximum(distance - radius[:, None], 0) / plain.step), low)
            last = np.minimum(np.floor((distance + radius[:, None]) / plain.step), high)
            first, last = first.astype(np.int64), last.astype(np.int64)
            allowed = NEAR_PIVOTS if stage == 1 else len(plain.pivots)
        rank = np.argsort(np.argsort(distance, axis=1, kind="stable"), axis=1)
        times = np.where(rank < allowed, np.maximum(last - first + 1, 0), 0)
        row, cell = np.nonzero(times)
        times = times[row, cell]
        if len(row):
            spread = np.repeat(np.arange(len(row)), times)
            ring = first[row, cell][spread] + np.arange(len(spread)) - np.repeat(np.cumsum(times) - times, times)
            own = batch.take(pa.array(row[spread]))
            yield pa.RecordBatch.from_arrays(
                [own.column(c) for c in ("query_id", "v", "least", "least_id")] + [pa.array(cell[spread]), pa.array(ring)],
                schema=schema,
            )

    kind = "query_id bigint, v array<bigint>, least bigint, least_id bigint, cell bigint, ring bigint"
    return queries.mapInArrow(choose, kind)


def _meet(probes: DataFrame, index: Index, blocks: int, k: int) -> DataFrame:
    """query_id, vec_id, score: up to ``k`` of each part that are better than what the query has."""
    width = index.width
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = left.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], matrix(left.column("v"), width)[order]
        names = right.column("query_id").to_numpy()
        least = [right.column(c).to_pylist() for c in ("least", "least_id")]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for low in range(0, len(names), 256):
            scores = products(matrix(right.column("v").slice(low, 256), width), vectors)
            for n, own in enumerate(scores):
                name, floor, floor_id = names[low + n], least[0][low + n], least[1][low + n]
                good = ids != name
                if floor is not None:
                    good &= (own > floor) | ((own == floor) & (ids < floor_id))
                at = np.flatnonzero(good)
                if len(at) > k:
                    edge = np.partition(own[at], len(at) - k)[len(at) - k]
                    at = at[own[at] >= edge]
                    at = at[np.argsort(-own[at], kind="stable")][:k]  # ids ascend, so ties go to the smaller
                if len(at):
                    out.append((np.full(len(at), name), ids[at], own[at]))
        if not out:
            return schema.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    keys = ["cell", "ring", "part", "block"]
    block = F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(blocks))
    right = (
        probes.join(index.parts, ["cell", "ring"])
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .withColumn("block", block)
        .drop("parts")
    )
    left = index.table.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, **fit) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other vectors for every query (all, if there are fewer).

    ``vectors`` has vec_id and v (see quantised); shorter vectors count as filled
    up with zeros. Ties go to the smaller vec_id. Rows with a query's vec_id are
    the query itself; of several, the smallest vector asks. Without vectors or
    queries the result is empty.
    """
    spark = vectors.sparkSession
    stored = materialize(vectors.select("vec_id", "v"), "vectors")
    index = build_index(stored, **fit)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if index is None:
        return empty
    asked = stored.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = materialize(asked, "queries")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    none = F.lit(None).cast("bigint")
    found = visited = None
    for stage in range(3):
        state = asked.withColumn("least", none).withColumn("least_id", none)
        if found is not None:
            last = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
            state = asked.join(last, "query_id", "left")
        probes = _annuli(state, index, stage)
        if visited is not None:
            probes = probes.join(visited, ["query_id", "cell", "ring"], "left_anti")
        probes = materialize(probes, "probes")
        seen = probes.select("query_id", "cell", "ring")
        visited = seen if visited is None else visited.unionByName(seen)
        fresh = _meet(probes, index, blocks, k)
        if found is not None:
            fresh = fresh.unionByName(found.select("query_id", "vec_id", "score"))
        found = materialize(_best(fresh, k), "best")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
