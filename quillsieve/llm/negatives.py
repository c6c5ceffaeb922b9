"""Hard negatives by coordinate pruning over length buckets.

Vectors are filed by label and length class; a class is cut into parts of
bounded size, and a part keeps one list for each coordinate, sorted by the value
the coordinate has in the vectors scaled to length one. A score of at least t
with an anchor needs a cosine of at least c = t / (|anchor| * longest of the
part). With that, the angle to an axis can differ from the anchor's by acos c at
most, so each of the anchor's strongest coordinates (its focus) confines the
vectors to a range of a sorted list. Vectors in all ranges are verified by exact
integer products.

Anchors first meet the fullest part of their own label; the scores found there
bound the search for positives in the other parts. The range
of scores that the positives allow for negatives bounds the last search, over
the other labels. Anchors go in blocks; a block meets only parts that some of
its anchors need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillsieve.llm.topk import matrix
from quillsieve.runtime import materialize

# Lengths in a class differ by this factor at most.
RATIO = 1.1
# Vectors of a part and anchors of a block, as far as a hash spreads evenly.
PART_ROWS = 8192
BLOCK_ROWS = 1024
FOCUS = 4
POSITIVES, NEGATIVES = 5, 5
LOW_PERCENT, HIGH_PERCENT = 80, 100
# Products are exact in doubles below this bound.
EXACT = float(2**53)
SALTS = 32


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and v (floor(scale * x) of every component).

    Rows without vec_id or label, and vectors that are null or hold null or
    non-finite components, are left out. Other columns are dropped.
    """
    x = F.col("embedding")
    usable = F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & usable)
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint")).alias("v"),
    )


def _length(v: str = "v") -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _products(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    top = float(np.abs(vectors).max(initial=0)) * float(np.abs(one).max(initial=0)) * max(1, len(one))
    if top < EXACT:
        return np.rint(vectors.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    if top < 2.0**63:
        return vectors @ one
    raise OverflowError("scores beyond 64 bits: quantise with a smaller scale")


class Part:
    """One part of the index in a task: vectors, ids, and sorted coordinate lists."""

    def __init__(self, rows: pa.Table, width: int):
        ids = rows.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], matrix(rows.column("v"), width)[order]
        plain = self.vectors.astype(np.float64)
        lengths = np.sqrt((plain * plain).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        unit = plain / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, axis=0)
        self.unit = unit

    def feasible(self, anchor: np.ndarray, least: float, focus: int) -> np.ndarray:
        """Rows that may score ``least`` or more with ``anchor``, in ascending order."""
        everything = np.arange(len(self.ids))
        if least <= 0:
            return everything
        plain = anchor.astype(np.float64)
        length = float(np.sqrt(plain @ plain))
        reach = length * self.longest
        # A hair below, for rounding.
        cosine = least / reach * (1 - 1e-9) - 1e-9 if reach > 0 else np.inf
        if cosine > 1:
            return everything[:0]
        spread = np.arccos(cosine)
        unit = plain / length
        strong = np.argsort(-np.abs(unit), kind="stable")[:focus]
        angle = np.arccos(np.clip(unit[strong], -1, 1))
        high = np.cos(np.maximum(angle - spread, 0)) + 1e-9
        low = np.cos(np.minimum(angle + spread, np.pi)) - 1e-9
        ends = [
            (int(np.searchsorted(self.sorted[:, f], a, "left")), int(np.searchsorted(self.sorted[:, f], b, "right")))
            for f, a, b in zip(strong, low, high)
        ]
        # The shortest range, less what lies outside the others.
        first = min(range(len(ends)), key=lambda n: ends[n][1] - ends[n][0])
        found = self.order[ends[first][0] : ends[first][1], strong[first]]
        for n, f in enumerate(strong):
            if n != first:
                value = self.unit[found, f]
                found = found[(value >= low[n]) & (value <= high[n])]
        return np.sort(found)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the earlier place (ids ascend)."""
    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
        return at[np.argsort(-scores[at], kind="stable")][:k]
    return np.argsort(-scores, kind="stable")


class Index:
    """Vectors filed by label, length class and part.

    ``table`` has vec_id, label, v, class, part; ``parts`` has label, class, part
    and longest (the length of its longest vector).
    """

    def __init__(self, rows: DataFrame, part_rows: int):
        measured = rows.withColumn("_length", _length()).withColumn("_row", F.monotonically_increasing_id())
        # Zero vectors are a class of their own.
        kind = F.when(F.col("_length") > 0, F.floor(F.ln(F.greatest("_length", F.lit(1e-300))) / float(np.log(RATIO)))).otherwise(-(10**6))
        stored = materialize(measured.withColumn("class", kind.cast("bigint")), "vectors")
        sizes = stored.groupBy("label", "class").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("bigint").alias("parts"))
        # Salted: one label and class may hold most rows.
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        salted = stored.withColumn("_salt", F.col("_row") % SALTS).join(
            sizes.withColumn("_salt", F.explode(salts)), ["label", "class", "_salt"]
        )
        part = F.pmod(F.xxhash64("_row"), F.col("parts"))
        self.table = materialize(salted.select("vec_id", "label", "v", "class", part.alias("part"), "_length"), "index")
        self.parts = materialize(
            self.table.groupBy("label", "class", "part").agg(F.max("_length").alias("longest"), F.count(F.lit(1)).alias("n")), "parts"
        )
        found = self.table.agg(F.max(F.size("v"))).first()[0]
        self.width = max(1, found or 0)


def _search(index: Index, anchors: DataFrame, pairs: DataFrame, positives: bool, focus: int) -> DataFrame:
    """What ``anchors`` find in the parts that ``pairs`` (block, label, class, part) name.

    Positives: anchor_id, vec_id, score, the best few of each part at or above
    ``least``. Negatives: for each positive, the first few of each part in its range.
    """
    width = index.width
    schema = pa.schema([("anchor_id", pa.int64()), ("place", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    kind = "anchor_id bigint, place bigint, vec_id bigint, score bigint"

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        part = Part(left, width)
        names, vectors = right.column("anchor_id").to_numpy(), matrix(right.column("v"), width)
        if positives:
            least = right.column("least").to_pylist()
        else:
            ranges = right.column("scores").to_pylist()
            # Integers: 80 * p <= 100 * s rounds up.
            lows = [[-(-LOW_PERCENT * p // 100) for p in own] for own in ranges]
            highs = [[HIGH_PERCENT * p // 100 for p in own] for own in ranges]
            least = [min((a for a, b in zip(*own) if a <= b), default=None) for own in zip(lows, highs)]
        out: list[tuple] = []

        def emit(name: int, place: int, at: np.ndarray, scores: np.ndarray, k: int) -> None:
            best = _first(at, scores, k)
            if len(best):
                out.append((np.full(len(best), name), np.full(len(best), place), part.ids[at[best]], scores[best]))

        own, label = right.column("own_label").to_numpy(), left.column("label")[0].as_py()
        for n, name in enumerate(names.tolist()):
            if not positives and (least[n] is None or own[n] == label):
                continue
            at = part.feasible(vectors[n], -np.inf if least[n] is None else float(least[n]), focus)
            if not len(at):
                continue
            scores = _products(part.vectors[at], vectors[n])
            other = part.ids[at] != name
            if positives:
                good = other if least[n] is None else other & (scores >= least[n])
                emit(name, 0, at[good], scores[good], POSITIVES)
            else:
                for place, (low, high) in enumerate(zip(lows[n], highs[n])):
                    good = other & (scores >= low) & (scores <= high)
                    if good.any():
                        emit(name, place, at[good], scores[good], NEGATIVES)
        if not out:
            return schema.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    keys = ["label", "class", "part", "block"]
    needed = materialize(pairs.select(*keys), "pairs")
    left = index.table.select("vec_id", "v", "label", "class", "part").join(needed, ["label", "class", "part"])
    right = anchors.join(needed, "block")
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, kind)


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, *, part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS, focus: int = FOCUS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and v (see quantised), without nulls; shorter
    vectors count as filled up with zeros. An anchor's positives are the 5 rows
    of its label with the highest scores, ties to the smaller vec_id; a
    positive's negatives the first 5 rows of other labels whose score lies
    between 80 % and 100 % of the positive's. Rows with the anchor's vec_id are
    the anchor itself; of several, the one with the smallest label and vector
    asks. Other repeated rows count as often as they occur. Without rows or
    anchors the result is empty.
    """
    index = Index(rows.select("vec_id", "label", "v"), part_rows)
    asked = rows.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v")).alias("own"))
    asked = asked.select("anchor_id", F.col("own.label").alias("own_label"), F.col("own.v").alias("v"))
    asked = asked.withColumn("_length", _length())
    # Blocks hold anchors of one label: as many numbers for each as the largest label needs.
    asked = materialize(asked, "anchors")
    largest = asked.groupBy("own_label").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-largest // block_rows))
    number = F.pmod(F.xxhash64("anchor_id", F.lit(7)), F.lit(blocks))
    asked = materialize(asked.withColumn("block", F.concat_ws(":", "own_label", number)), "blocks")

    # Positives: first the fullest part of the label, then all that its scores leave open.
    order = Window.partitionBy("label").orderBy(F.desc("n"), F.desc("longest"), "class", "part")
    start = index.parts.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    own = asked.select("block", F.col("own_label").alias("label")).distinct()
    none = F.lit(None).cast("bigint")
    state = asked.withColumn("least", none)
    found = materialize(_search(index, state, own.join(start, "label"), True, focus), "found")
    floor = _best(found, POSITIVES, "anchor_id").where(F.col("rank") == POSITIVES).select("anchor_id", F.col("score").alias("least"))
    state = materialize(asked.join(floor, "anchor_id", "left"), "state")
    # A part is needed if its longest vector could reach the score that some anchor of the block still needs.
    need = F.coalesce(F.when(F.col("least") <= 0, 0.0).otherwise(F.col("least") / F.col("_length")), F.lit(0.0))
    wanted = state.groupBy("block", F.col("own_label").alias("label")).agg(F.min(need).alias("need"))
    rest = wanted.join(index.parts, "label").where(F.col("longest") * (1 + 1e-9) >= F.col("need"))
    rest = rest.join(start.select("label", "class", "part"), ["label", "class", "part"], "left_anti")
    more = _search(index, state, rest, True, focus)
    positives = materialize(
        _best(more.unionByName(found), POSITIVES, "anchor_id").select("anchor_id", "rank", "vec_id", "score"), "positives"
    )

    # Negatives: scores in descending order, so a score's place tells its positive.
    listed = F.sort_array(F.collect_list(F.struct("rank", "score")))
    scored = positives.groupBy("anchor_id").agg(F.transform(listed, lambda p: p["score"]).alias("scores"))
    state = asked.join(scored, "anchor_id")
    # Now blocks of any labels: an anchor skips the parts of its own.
    blocks = max(1, -(-asked.count() // block_rows))
    state = materialize(state.withColumn("block", F.pmod(F.xxhash64("anchor_id", F.lit(7)), F.lit(blocks)).cast("string")), "state")
    lowest = F.array_min(F.transform(F.filter("scores", lambda p: p >= 0), lambda p: F.ceil(p * LOW_PERCENT / 100)))
    need = F.when(lowest <= 0, 0.0).otherwise(lowest / F.col("_length"))
    wanted = state.withColumn("need", need).where(F.col("need").isNotNull())
    wanted = wanted.groupBy("block").agg(F.min("need").alias("need"))
    # Length classes are few (one for each 10 % of length), whatever the size of the table.
    classes = sorted(r["class"] for r in index.parts.select("class").distinct().collect())
    each = wanted.withColumn("class", F.explode(F.lit(classes).cast("array<bigint>")))
    pairs = each.join(index.parts, "class").where(F.col("longest") * (1 + 1e-9) >= F.col("need"))
    found = _search(index, state, pairs, False, focus)
    answer = _best(found, NEGATIVES, "anchor_id", "place")
    named = positives.select(
        "anchor_id", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return answer.withColumnRenamed("vec_id", "negative_id").join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        F.col("score").alias("negative_score"),
    )
