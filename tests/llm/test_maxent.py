"""Maximum-entropy scores: base measures by brute force, probabilities that add up, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import maxent, queries

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "One two ONE two."), (None, "one more"), (6, "é É " * 5), (7, "w " * 30000), (7, "w " * 30000)]


def brute_base(rows):
    lists = [[w.lower() for w in (t or "").encode().split()] + [b""] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    counts = Counter(w for words, out in zip(lists, held) if not out for w in words)
    n, v = sum(counts.values()), len(counts)
    per = math.log10(n + 0.5 * (v + 1))
    return [(d, out, len(words), sum(counts[w] > 0 for w in words), n, sum(math.log10(counts[w] + 0.5) - per for w in words))
            for (d, _), words, out in zip(rows, lists, held)]


def compare(got, rows):
    key = lambda r: (repr(r[0]), r[2], r[3])
    mine = sorted([tuple(r)[:6] for r in got], key=key)
    want = sorted(brute_base(rows), key=key)
    assert [r[:5] for r in mine] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in mine], [r[5] for r in want], rtol=1e-9)


@pytest.mark.parametrize("head", [100_000, 50])
def test_query_equals_brute_force_and_gains(spark, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op7_maxent(spark, SMALL).collect()
    compare(got, rows)
    assert all(r["score"] < 0 for r in got)
    if head > 50:
        out = [r for r in got if r["held_out"]]
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("key", F.lit(1))
    got = maxent.train_and_score(docs).collect()
    compare(got, ODD)
    assert len({r["score"] for r in got if r["doc_id"] == 7}) == 1
    assert maxent.train_and_score(docs.limit(0)).collect() == []
    held = spark.createDataFrame([(d, "a b") for d in range(40) if zlib.crc32(str(d).encode()) % 5 == 1], "doc_id long, text string")
    none = maxent.train_and_score(held).collect()
    assert {(r["train_tokens"], r["base_score"], r["n_known"]) for r in none} == {(0, 0.0, 0)}


def test_probabilities_add_up():
    words = [(b"", 50), *((f"w{i}".encode(), 40 - i) for i in range(30)), (b"rare,", 1), (b"seldom.", 1)]
    rest = words[20:]
    totals, kinds = np.zeros(maxent.SHAPE_CLASSES), np.zeros(maxent.SHAPE_CLASSES)
    units = maxent.UNIT_CLASSES, maxent.UNITS
    try:
        maxent.UNIT_CLASSES, maxent.UNITS = 4, 5
        maxent.CLASSES = 4 + maxent.SHAPE_CLASSES
        for word, c in rest:
            totals[maxent.shape_class(word)] += c
            kinds[maxent.shape_class(word)] += 1
        model = maxent.Model(words, totals, kinds, sum(c for _, c in words), len(words))
        model.weights = np.random.default_rng(1).normal(0, 1, len(model.weights)).astype(np.float32)
        total = 0.0
        known = dict(words)
        unseen = {}
        for word in [*known, *(f"{stem}{end}".encode() for stem in ("zz", "zzzzzzzzzz", "ü", "üzzzzzzz") for end in ("", ".", ",", "!", "#"))]:
            tokens = maxent.Tokens(model, [[b"w1", b"w25", word]] if word else [[b"w1", b"w25"]])
            place = 2
            chance = maxent.log_probabilities(model, tokens)[place]
            if not tokens.unit[place]:
                if word not in known:
                    if int(tokens.classes[place]) in unseen:
                        continue
                    unseen[int(tokens.classes[place])] = word
                chance += math.log(known.get(word, 0) + 0.5)
            total += math.exp(chance)
        assert len(unseen) == maxent.SHAPE_CLASSES
        assert total == pytest.approx(1, abs=1e-4)
    finally:
        maxent.UNIT_CLASSES, maxent.UNITS = units
        maxent.CLASSES = maxent.UNIT_CLASSES + maxent.SHAPE_CLASSES


def test_shape_classes_are_numbered():
    shapes = {maxent.shape_class(w.encode()) for w in ["a", "abcdefgh", "é", "éabcdefgh", "a.", "é.", "a,", "é,", "a!", "é!", "a#", "é#"]}
    assert shapes == set(range(maxent.SHAPE_CLASSES))


def test_three_words_of_context_and_960_units():
    words = [(b"", 2000), *((f"w{i}".encode(), 1500 - i) for i in range(1100))]
    rest = [(w, c) for w, c in words[20 * 48:]]
    totals, kinds = np.zeros(maxent.SHAPE_CLASSES), np.zeros(maxent.SHAPE_CLASSES)
    for word, c in rest:
        totals[maxent.shape_class(word)] += c
        kinds[maxent.shape_class(word)] += 1
    model = maxent.Model(words, totals, kinds, sum(c for _, c in words), len(words))
    model.weights = np.random.default_rng(2).normal(0, 1, len(model.weights)).astype(np.float32)

    def chance(*tokens):
        return maxent.log_probabilities(model, maxent.Tokens(model, [[t.encode() for t in tokens]]))[len(tokens) - 1]

    # The third word before changes the class; the words before, and the one before them, change the word within its class.
    assert abs(chance("w1", "w2", "w3", "w5") - chance("w9", "w2", "w3", "w5")) > 1e-3
    within = [chance(a, b, "w950") - chance(a, b, "w951") for a, b in (("w2", "w3"), ("w2", "w9"), ("w9", "w3"))]
    assert abs(within[0] - within[1]) > 1e-3 and abs(within[0] - within[2]) > 1e-3


def test_shape_classes_are_those_of_single_words():
    words = [bytes([b]) for b in range(1, 256)] + [b"abcdefg" + bytes([b]) for b in range(256)] + ["é,".encode(), "abcdefgé".encode(), b"a" * 7, b"a" * 8]
    assert maxent.shape_classes(pa.array(words, pa.binary())).tolist() == [maxent.shape_class(w) for w in words]
    assert maxent.shape_classes(pa.array([], pa.binary())).tolist() == []


def test_tokens_looks_at_distinct_words_at_once(monkeypatch):
    model = maxent.Model([(b"", 2), (b"a", 3)], np.zeros(maxent.SHAPE_CLASSES), np.zeros(maxent.SHAPE_CLASSES), 5, 2)
    shapes = {w: maxent.shape_class(w) + maxent.UNIT_CLASSES for w in (b"new.", b"other")}
    monkeypatch.setattr(maxent, "shape_class", None)
    tokens = maxent.Tokens(model, [[b"new.", b"a", b"new."], [], [b"other"]])
    assert tokens.rank.tolist() == [-1, 1, -1, 0, 0, -1, 0]
    assert (tokens.rare_words, tokens.rare_at.tolist(), tokens.rare_ids.tolist()) == ([b"new.", b"other"], [0, 2, 5], [0, 0, 1])
    assert tokens.classes[[0, 2, 5]].tolist() == [shapes[b"new."], shapes[b"new."], shapes[b"other"]]
    assert tokens.owner.tolist() == [0, 0, 0, 0, 1, 2, 2]


def test_a_step_equals_plain_loops():
    random = np.random.default_rng(3)
    features = [random.integers(0, 40, 500), 2000 + random.integers(0, 1500, 500)]
    error = random.normal(size=(500, 4)).astype(np.float32)
    rows, squares = random.normal(size=(3500, 4)).astype(np.float32), random.random((3500, 4)).astype(np.float32)
    met, want, want_squares, want_met = np.zeros(3500), rows.copy(), squares.copy(), np.zeros(3500)
    for feature in features:
        for row in np.unique(feature):
            times = (feature == row).sum()
            gradient = error[feature == row].astype(float).sum(axis=0) / math.sqrt(times)
            want_squares[row] += gradient**2
            want[row] -= maxent.RATE * gradient / np.sqrt(want_squares[row] + 1.0)
            want_met[row] += times
    maxent._step(rows, squares, met, features, error)
    assert np.allclose(rows, want, atol=1e-6) and np.allclose(squares, want_squares, rtol=1e-5)
    assert met.tolist() == want_met.tolist()


def test_split_keeps_to_ascii_white_space_and_case():
    some = [None, "", " \t\n\x0b\x0c\r", "One\ttwo  ONE\x0b\x0cÉé\x1fx y z\r", " é ", "a\x00B"]
    lists = maxent.split(pa.array(some))
    want = [(t or "").encode().lower().split() for t in some]
    assert [[w.encode() for w in words or []] for words in lists.to_pylist()] == want
    model = maxent.Model([(b"", 2), (b"one", 3)], np.zeros(maxent.SHAPE_CLASSES), np.zeros(maxent.SHAPE_CLASSES), 5, 2)
    mine, plain = maxent.Tokens(model, lists), maxent.Tokens(model, want)
    assert mine.rare_words == plain.rare_words and mine.rank.tolist() == plain.rank.tolist()
    assert mine.owner.tolist() == plain.owner.tolist() == np.repeat(np.arange(len(want)), [len(w) + 1 for w in want]).tolist()
    assert all((a == b).all() for a, b in zip(mine.features + mine.unit_features, plain.features + plain.unit_features))


def test_byte_strings_of_slices():
    words = pa.array([b"one", b"", "é".encode(), b"last"], pa.binary())
    assert [maxent.byte_strings(words[a:]) for a in range(5)] == [words.to_pylist()[a:] for a in range(5)]


@pytest.mark.parametrize("spread", [1, 2.5, 30])
def test_scores_are_those_of_sums_of_weights_whatever_their_size(spread):
    words = [(b"", 2000), *((f"w{i}".encode(), 1500 - i) for i in range(1100))]
    model = maxent.Model(words, np.full(maxent.SHAPE_CLASSES, 9.0), np.full(maxent.SHAPE_CLASSES, 3.0), sum(c for _, c in words), len(words))
    random = np.random.default_rng(4)
    model.weights = random.normal(0, spread, len(model.weights)).astype(np.float32)
    tokens = maxent.Tokens(model, [[f"w{i}".encode() for i in random.integers(0, 1200, 5000)]])
    got = maxent.log_probabilities(model, tokens)
    # Products of powers of e where they fit into a float, and never the powers of former weights.
    assert (model.raised() is not None) == (spread < 4)
    rows, unit_rows = model.views(model.weights.astype(float))

    def chances(bias, rows, features, right):
        logits = bias + sum(rows[f] for f in features)
        top = logits.max(axis=1, keepdims=True)
        return (logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True)))[np.arange(len(right)), right]

    want = chances(model.class_bias, rows, tokens.features, tokens.classes)
    at = np.flatnonzero(tokens.unit)
    want[at] += chances(model.unit_bias[tokens.classes[at]], unit_rows, [f[at] for f in tokens.unit_features], tokens.rank[at] % maxent.UNITS)
    want[~tokens.unit] -= model.log_shape_total[tokens.classes[~tokens.unit] - maxent.UNIT_CLASSES]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
    model.weights = np.zeros_like(model.weights)
    assert not np.allclose(maxent.log_probabilities(model, tokens), got)


def test_training_looks_for_one_exponential_a_logit(monkeypatch):
    model = maxent.Model([(b"", 20), *((f"w{i}".encode(), 10) for i in range(1100))], np.full(maxent.SHAPE_CLASSES, 9.0),
                         np.full(maxent.SHAPE_CLASSES, 3.0), 11_000, 1101)
    tokens = maxent.Tokens(model, [[f"w{i}".encode() for i in range(1000)]])
    sizes, seen, exp = maxent.Model.sizes(), [], np.exp
    met = np.zeros(sizes[1] // maxent.CLASSES), np.zeros((sizes[2] - sizes[1]) // maxent.UNITS)
    monkeypatch.setattr(np, "exp", lambda x, *a, **b: (seen.append(x.size), exp(x, *a, **b))[1])
    maxent.train_on(model, model.weights.copy(), np.zeros_like(model.weights), met, tokens)
    assert sum(seen) == len(tokens.rank) * maxent.CLASSES + int(tokens.unit.sum()) * maxent.UNITS
