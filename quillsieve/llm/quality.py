"""Quality scores by compression with two dictionaries.

A zstandard dictionary is trained on a sample of texts labelled good, another on
texts labelled bad. A text is compressed in chunks with either; the difference
of the two sizes, divided by the text's bytes, says which class it resembles.
A logistic curve over that and the compressed share of the text (endless
repetition compresses to nothing under both) turns it into a calibrated score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillsieve.llm import arrow

FOLDS = 5
THRESHOLD = 0.3
# Labelled documents of each class that are learned from: half for the dictionaries, half for the curve.
SAMPLE_DOCS = 1600
# Of a document in a dictionary's sample, so many characters at most.
SAMPLE_CHARS = 8000
DICTIONARY_BYTES = 32768
CHUNK_BYTES = 1500
LEVEL = 3


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    good: bytes
    bad: bytes
    trained: bool
    weights: list[float]  # constant, difference, compressed share

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in (self.good, self.bad):
            kind = zstandard.DICT_TYPE_FULLDICT if self.trained else zstandard.DICT_TYPE_RAWCONTENT
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
            dictionary.precompute_compress(level=LEVEL)
            out.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                )
            )
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        line = self.weights[0] + features @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(line, -60, 60)))


def features(texts: list[str | None], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """(bad - good) / bytes and good / bytes of each text; zeros for an empty one."""
    good, bad = compressors
    out = np.zeros((len(texts), 2))
    for n, text in enumerate(texts):
        data = (text or "").encode()
        if data:
            chunks = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
            one = sum(len(good.compress(c)) for c in chunks)
            two = sum(len(bad.compress(c)) for c in chunks)
            out[n] = (two - one) / len(data), one / len(data)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Weighted logistic regression (Newton's method, slight ridge)."""
    middle, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - middle) / scale])
    beta = np.zeros(z.shape[1])
    ridge = np.diag([0.0, 1.0, 1.0]) * 1e-2 + np.eye(3) * 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -60, 60)))
        step = np.linalg.solve(
            (z.T * (weight * p * (1 - p))) @ z + ridge, z.T @ (weight * (y - p)) - ridge @ beta
        )
        beta += np.clip(step, -5, 5)
    slope = beta[1:] / scale
    return [float(beta[0] - slope @ middle), *map(float, slope)]


def _dictionaries(texts: dict[int, list[bytes]]) -> tuple[bytes, bytes, bool]:
    made = []
    try:
        for label in (1, 0):
            pieces = [t[i : i + CHUNK_BYTES] for t in texts[label] for i in range(0, len(t), CHUNK_BYTES)]
            made.append(zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes())
        return made[0], made[1], True
    except zstandard.ZstdError:  # too few samples to train on: their text itself
        raw = [b"\n".join(texts[label])[-DICTIONARY_BYTES:] for label in (1, 0)]
        return raw[0], raw[1], False


def learn(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS) -> Model | float:
    """A model from labelled rows outside the held-out fold; a constant score if a class has none.

    At most ``sample_docs`` documents of each class are read, chosen by a hash of
    doc_id. Rows without doc_id or label are left out.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    totals = dict(known.groupBy("label").count().collect())
    if len(totals) < 2:
        return float(*totals) if totals else 1.0
    order = F.xxhash64("doc_id")
    drawn = [known.where(F.col("label") == c).orderBy(order, "doc_id").limit(sample_docs) for c in (0, 1)]
    # At most 2 * sample_docs rows, so they go to every task.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    chosen = chosen.withColumn("for_dictionary", F.xxhash64("doc_id", F.lit(1)) % 2 == 0)
    for_dictionary = chosen.where("for_dictionary").select("label", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in for_dictionary.orderBy("label", "text").collect():
        texts[row.label].append((row.text or "").encode())
    good, bad, trained = _dictionaries(texts)
    model = Model(good, bad, trained, [0.0, 0.0, 0.0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for part in arrow.slices(batches, "text"):
            x = features(part.column("text").to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(x[:, 0]), pa.array(x[:, 1])], ["label", "difference", "share"]
            )

    rest = chosen.where("not for_dictionary").select("label", "text")
    points = rest.mapInArrow(measure, "label int, difference double, share double").toPandas()
    counts = points["label"].value_counts()
    if len(counts) < 2:
        return totals[1] / sum(totals.values())
    # Both classes are sampled to the same size: weights restore their shares.
    weight = points["label"].map(lambda c: totals[c] / counts[c]).to_numpy()
    weight = weight / weight.mean()
    x = points[["difference", "share"]].to_numpy()
    order = np.lexsort((x[:, 1], x[:, 0], points["label"]))
    model.weights = fit_curve(x[order], points["label"].to_numpy(float)[order], weight[order])
    return model


def score(docs: DataFrame, model: Model | float, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``, 0 to 1: the chance that the whole text is of good quality.

    A null or empty text scores 0 under a model. A column of that name in the input is replaced.
    """
    kept = [c for c in docs.columns if c != out]
    rows = docs.select(*kept)
    if not isinstance(model, Model):
        return rows.withColumn(out, F.lit(float(model)))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for part in arrow.slices(batches, "text"):
            texts = part.column("text").to_pylist()
            values = np.where([bool(t) for t in texts], model.score(features(texts, compressors)), 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], [*part.schema.names, out])

    return rows.mapInArrow(rate, StructType([*rows.schema.fields, StructField(out, DoubleType())]))
