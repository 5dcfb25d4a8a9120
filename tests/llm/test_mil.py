"""The attention classifier: gradients, held-out accuracy, odd texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import mil, queries

DATA = "/root/testdata/sf0.01"
TEXTS = ["plain words go here and there, " * 20, "", " \n\t", "a", "bad*** words&&& " * 40, "é" * 500, "x y " * 20000, None]


def test_gradients_equal_differences():
    x, counts = mil.encode(TEXTS[:1] + TEXTS[3:6])
    labels = np.array([1.0, 0, 0, 1])
    model = mil.GatedAttention()
    model.output += 0.3
    gradients = model.gradients(x, counts, labels)

    def loss():
        score = model.forward(x, counts)["score"]
        return -np.mean(labels * np.log(score) + (1 - labels) * np.log(1 - score))

    for name, gradient in gradients.items():
        weight = getattr(model, name)
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 1e-5
        above = loss()
        weight[at] = kept - 1e-5
        below = loss()
        weight[at] = kept
        assert abs((above - below) / 2e-5 - gradient[at]) < 1e-6


def test_passages_do_not_depend_on_neighbours():
    texts = [t or "" for t in TEXTS]
    together, counts = mil.encode(texts)
    alone = [mil.encode([t])[0] for t in texts]
    assert [len(a) for a in alone] == counts.tolist()
    assert np.array_equal(together, np.concatenate(alone))
    assert counts[6] == -(-40000 // mil.PASSAGE_WORDS)


def test_held_out_accuracy(spark):
    scored = queries.op5_quality_mil(spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").filter("quality is not null")
    rows = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert scored.count() == docs.count()
    assert scored.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = mil.train(docs, labels, rows=100), mil.train(docs, flipped, rows=100)
    assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in mil.GatedAttention.NAMES)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i or None, t) for i, t in enumerate(TEXTS)] + [(3, "a")], "doc_id long, text string").withColumn("label", F.lit(9))
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 1), (4, 0)], "doc_id long, quality int")
    model = mil.train(docs, labels)
    rows = mil.score(docs, model).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    assert {r["score"] for r in mil.score(docs, mil.train(docs, labels.limit(0))).collect()} == {0.5}
    assert mil.score(docs.limit(0), model).collect() == []


def test_no_passage_is_left_out_of_training(spark):
    x = np.arange(1000, dtype=np.float32).reshape(500, 2)
    few = mil.grouped(x, 7)
    sizes = np.diff(np.r_[np.arange(7) * 500 // 7, 500])
    assert few.shape == (7, 2) and np.allclose((few * sizes[:, None]).sum(axis=0), x.sum(axis=0))
    assert mil.grouped(x[:7], 7) is not None and (mil.grouped(x[:7], 7) == x[:7]).all() and len(mil.grouped(x[:0], 7)) == 0
    # One bad passage among very many good ones changes the bag.
    good = "These are plain words of a text that goes on. " * 4000
    texts = [good, good[:90_000] + " ### !!! 12$ " * 20 + good[90_000:]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    bags = mil.training_bags(docs, labels, "quality", 10, 1000, 999).collect()
    assert len(bags) == 2 and bytes(bags[0]["features"]) != bytes(bags[1]["features"])
    assert {len(b["features"]) for b in bags} == {mil.TRAIN_GROUPS * mil.FEATURES * 4}


def brute_score(model, text):
    """The score of one text, passage by passage in plain loops."""
    x, counts = mil.encode([text])
    energies, hidden = [], []
    for passage in x:
        h = np.tanh((passage - model.mean) / model.scale @ model.hidden + model.hidden_bias)
        energies.append(sum(model.attention[k] * np.tanh(h @ model.value[:, k]) / (1 + np.exp(-h @ model.gate[:, k]))
                            for k in range(mil.ATTENTION)))
        hidden.append(h)
    weights = np.exp(np.array(energies) - max(energies)) if energies else np.zeros(0)
    pooled = sum((w / weights.sum() * h for w, h in zip(weights, hidden)), np.zeros(mil.HIDDEN))
    return 1 / (1 + np.exp(-(pooled @ model.output + model.bias[0])))


def test_scores_match_plain_loops(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = mil.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in mil.score(docs, model).collect()}
    for doc in docs.collect():
        assert got[doc["doc_id"]] == pytest.approx(brute_score(model, doc["text"] or ""), abs=1e-6)
