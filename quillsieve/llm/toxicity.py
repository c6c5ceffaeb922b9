"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-cased words and word beginnings of 4, 5 and 6 bytes,
hashed to 2**18 buckets. Buckets that tell toxic from clean labelled texts (a
likelihood-ratio test over the sample) are the features; each present feature
has the value 1 / sqrt(features of the text). Besides a weight, every feature
has a vector; the products of two features' vectors add what the pair says
beyond its members, such as an insult next to the mention of a group. Weights
and vectors are fitted by stochastic gradient steps on a bounded sample of
labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillsieve.llm import arrow
from quillsieve.llm.quality import held_out
from quillsieve.llm.words import Words, mix, read_words
from quillsieve.runtime import materialize

THRESHOLD = 0.5
BITS = 18
BEGINNINGS = (4, 5, 6)
# Labelled documents of each class that are learned from.
SAMPLE_DOCS = 3000
# A feature occurs in so many of them, and its likelihood ratio (twice the logarithm) reaches this.
LEAST_DOCS = 4
LEAST_RATIO = 15.0
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.2
RIDGE = 1e-4


def terms(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every distinct term of each text, in ascending order; of ``known`` buckets, if given."""
    words = read_words(pc.utf8_lower(texts))
    text = np.repeat(np.arange(len(texts)), words.sizes)
    lengths = words.ends - words.starts
    found = []
    for size in (0, *BEGINNINGS):
        own = lengths > size if size else np.ones(len(lengths), bool)
        starts = words.starts[own]
        ends = starts + size if size else words.ends
        hashes = mix(Words(words.data, starts, ends, words.sizes).hashes() + np.uint64(size))
        bucket = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
        key = text[own] << BITS | bucket
        if known is not None:
            key = key[known[bucket]]
        found.append(np.unique(key))
    key = np.unique(np.concatenate(found))
    return key >> BITS, key & ((1 << BITS) - 1)


def likelihood_ratio(both: np.ndarray, docs: np.ndarray, toxic: float, total: float) -> np.ndarray:
    """Twice the log likelihood ratio of presence and class; ``both`` toxic texts of ``docs`` have the term."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0)

    share = toxic / total
    rest = total - docs
    return 2 * (
        part(both, docs * share)
        + part(docs - both, docs * (1 - share))
        + part(toxic - both, rest * share)
        + part(rest - (toxic - both), rest * (1 - share))
    )


@dataclass
class Model:
    """Weights of the chosen ``buckets``."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def places(self) -> np.ndarray:
        """The number of each bucket's feature, -1 without one."""
        out = np.full(1 << BITS, -1, np.int64)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def line(self, text: np.ndarray, feature: np.ndarray, count: int) -> np.ndarray:
        """The machine's value for each of ``count`` texts, from (text, feature) pairs."""
        value = 1 / np.sqrt(np.maximum(np.bincount(text, minlength=count), 1))[text]
        total = self.bias + np.bincount(text, self.weights[feature] * value, count)
        for f in range(self.vectors.shape[1]):
            part = self.vectors[feature, f] * value
            # The sum over pairs: (square of the sum - sum of squares) / 2.
            total += (np.bincount(text, part, count) ** 2 - np.bincount(text, part * part, count)) / 2
        return total


def chance(line: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(line, -60, 60)))


def fit(text: np.ndarray, feature: np.ndarray, label: np.ndarray, weight: np.ndarray, model: Model) -> None:
    """Adaptive gradient steps on the weighted log loss, over texts in a fixed shuffled order."""
    rng = np.random.default_rng(1)
    model.vectors[:] = rng.normal(0, 0.05, model.vectors.shape)
    first = np.searchsorted(text, np.arange(len(label) + 1))
    square, square_of = np.full(len(model.weights), 1e-8), np.full(model.vectors.shape, 1e-8)
    square_bias = 1e-8
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for rows in (order[i : i + BATCH] for i in range(0, len(order), BATCH)):
            sizes = first[rows + 1] - first[rows]
            own = np.repeat(np.arange(len(rows)), sizes)
            at = np.repeat(first[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(own))
            feat = feature[at]
            value = 1 / np.sqrt(np.maximum(sizes, 1))[own]
            error = (chance(model.line(own, feat, len(rows))) - label[rows]) * weight[rows] / len(rows)
            used, place = np.unique(feat, return_inverse=True)
            step = np.bincount(place, error[own] * value, len(used)) + RIDGE * model.weights[used]
            steps = RIDGE * model.vectors[used]
            for f in range(model.vectors.shape[1]):
                part = model.vectors[feat, f] * value
                sums = np.bincount(own, part, len(rows))
                steps[:, f] += np.bincount(place, error[own] * value * (sums[own] - part), len(used))
            square[used] += step**2
            square_of[used] += steps**2
            square_bias += error.sum() ** 2
            model.weights[used] -= RATE * step / np.sqrt(square[used])
            model.vectors[used] -= RATE * 0.3 * steps / np.sqrt(square_of[used])
            model.bias -= RATE * error.sum() / np.sqrt(square_bias)


def learn(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS) -> Model | float:
    """A model from labelled rows outside the held-out fold; a constant score if a class or every feature is missing.

    ``labels`` has doc_id and toxic (0 or 1; other rows are left out, and of
    several labels of one document the toxic one counts). At most ``sample_docs``
    documents of each class, chosen by a hash of doc_id, are read; of several
    texts with a sampled doc_id the one with the smallest hash. The statistics of
    the terms are Spark aggregates over the sample; the driver gets one row for
    each bucket, and of each sampled text the buckets that became features.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    known = materialize(known, "labels")
    totals = dict(known.groupBy("label").count().collect())
    if len(totals) < 2:
        return float(next(iter(totals), 0))
    drawn = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for c in (0, 1)]
    # At most 2 * sample_docs rows, so they go to every task.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    chosen = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    chosen = chosen.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("buckets", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, "text"):
            text, bucket = terms(part.column("text"))
            ends = np.searchsorted(text, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
            yield arrow.batch(schema, part.column("doc_id"), part.column("label"), lists)

    seen = materialize(chosen.mapInArrow(read, "doc_id bigint, label int, buckets array<int>"), "terms")
    counts = dict(seen.groupBy("label").count().collect())
    if len(counts) < 2:
        return totals[1] / sum(totals.values())
    # One row for each bucket at most.
    rated = (
        seen.select("label", F.explode("buckets").alias("bucket"))
        .groupBy("bucket").agg(F.sum("label").alias("both"), F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= LEAST_DOCS).toPandas()
    )
    ratio = likelihood_ratio(rated["both"].to_numpy(float), rated["docs"].to_numpy(float), counts[1], sum(counts.values()))
    buckets = np.sort(rated["bucket"].to_numpy()[ratio >= LEAST_RATIO])
    if not len(buckets):
        return totals[1] / sum(totals.values())
    model = Model(buckets, 0.0, np.zeros(len(buckets)), np.zeros((len(buckets), FACTORS)))
    places = model.places()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            feature = places[lists.flatten().to_numpy()]
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())[feature >= 0]
            ends = np.searchsorted(row, np.arange(len(lists) + 1))
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature[feature >= 0], pa.int32()))
            yield arrow.batch(schema, batch.column("doc_id"), batch.column("label"), kept)

    rows = seen.mapInArrow(keep, "doc_id bigint, label int, buckets array<int>").toArrow().sort_by("doc_id")
    lists, label = rows.column("buckets").combine_chunks(), rows.column("label").to_numpy().astype(float)
    sizes = pc.list_value_length(lists).to_numpy()
    # Both classes are sampled up to the same size: weights restore their shares.
    weight = np.where(label > 0, totals[1] / counts[1], totals[0] / counts[0])
    fit(np.repeat(np.arange(len(label)), sizes), lists.flatten().to_numpy(), label, weight / weight.mean(), model)
    return model


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``docs`` with ``score``, 0 to 1: the chance that the whole text is toxic.

    A null, empty or wordless text has no features and scores what the bias
    says. A column ``score`` of the input is replaced.
    """
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(*kept)
    if not isinstance(model, Model):
        return rows.withColumn("score", F.lit(float(model)))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = model.places()
        for part in arrow.slices(batches, "text"):
            text, bucket = terms(part.column("text"), places >= 0)
            value = chance(model.line(text, places[bucket], part.num_rows))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], [*part.schema.names, "score"])

    return rows.mapInArrow(rate, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
