"""Toxicity scores: the machine against its plain formula, pairs, and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa

from quillsieve.llm import queries, toxicity


def plain_score(model, text):
    """The machine's formula, pair by pair, for one text."""
    _, buckets = toxicity.terms(pa.array([text], pa.string()))
    place = {b: n for n, b in enumerate(model.buckets.tolist())}
    own = [place[b] for b in set(buckets.tolist()) if b in place]
    x = 1 / np.sqrt(max(1, len(own)))
    total = model.bias + sum(model.weights[i] * x for i in own)
    for n, i in enumerate(own):
        total += sum(model.vectors[i] @ model.vectors[j] * x * x for j in own[:n])
    return 1 / (1 + np.exp(-total))


def labelled(spark, count=900, seed=4):
    """Toxic is an insult next to a mention of a group; either alone is not."""
    r = random.Random(seed)
    rows = []
    for n in range(count):
        words = [f"word{r.randrange(60)}" for _ in range(r.randint(5, 12))]
        insult, group = n % 2 == 0, n % 4 < 2
        words += ["vermin"] * insult + ["martians"] * group
        r.shuffle(words)
        rows.append((n, " ".join(words), int(insult and group)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id bigint, text string").repartition(3)
    return docs, spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id bigint, toxic int"), {x[0]: x[2] for x in rows}


def test_pairs_and_formula(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs.withColumn("held", toxicity.held_out(docs.doc_id)), model).collect()
    held = [x for x in rows if x.held]
    assert np.mean([(x.score >= 0.5) == truth[x.doc_id] for x in held]) > 0.97
    for x in rows[:40]:
        assert abs(x.score - plain_score(model, x.text)) < 1e-9
    again = toxicity.learn(docs.repartition(5), labels.repartition(2))
    assert (again.buckets == model.buckets).all() and np.allclose(again.weights, model.weights)


def test_terms_are_words_and_beginnings():
    text, bucket = toxicity.terms(pa.array(["Abc abc", "abcdefgh", None, "", "É é"], pa.string()))
    assert np.bincount(text, minlength=5).tolist() == [1, 4, 0, 0, 1]
    long = " ".join(f"w{n}" for n in range(200_000))
    text, bucket = toxicity.terms(pa.array([long + " vermin", "vermin"]))
    assert set(bucket[text == 1]) <= set(bucket[text == 0])


def test_edges(spark):
    docs, labels, _ = labelled(spark, 300)
    odd = [(None, "vermin martians", "x", 3), (900, None, "y", 4), (901, "", None, None), (901, " \n", "z", 5), (901, "word1 " * 400_000 + "vermin martians", "z", 5)]
    odd = spark.createDataFrame(odd, "doc_id bigint, text string, label string, score int")
    model = toxicity.learn(docs.unionByName(odd.select("doc_id", "text")), labels.union(labels).union(spark.createDataFrame([(None, 1), (901, None), (1, 7)], "doc_id bigint, toxic int")))
    got = toxicity.score(odd, model).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "label", "score"} and len(got) == 5
    assert all(0 <= x.score <= 1 for x in got)
    scores = {(x.text or "")[:6]: x.score for x in got}
    assert scores["vermin"] > 0.5 and got[1].score == got[2].score == got[3].score < 0.5
    assert got[4].score > 0.5
    empty = docs.limit(0)
    assert toxicity.score(empty, model).collect() == []
    assert isinstance(toxicity.learn(empty, labels), float)
    assert toxicity.learn(docs, labels.where("toxic = 0")) == 0.0
    assert toxicity.learn(docs, labels.limit(0)) == 0.0
    assert toxicity.score(docs.limit(2), 0.0).select("score").distinct().collect()[0].score == 0.0


def test_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = [r for r in queries.op11_toxicity(spark, sf_dir).collect() if r.held_out and labels.get(r.doc_id) is not None]
    toxic = [r.predicted for r in rows if labels[r.doc_id]]
    clean = [r.predicted for r in rows if not labels[r.doc_id]]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01
