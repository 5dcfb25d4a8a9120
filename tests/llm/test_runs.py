"""Runs of words against brute force."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import queries, runs
from larder.llm.common import table

SMALL = "/root/testdata/sf0.001"


def brute(words, shortest=12):
    """(start, length, period) of every run, by comparing the words at every distance."""
    smallest = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at < len(words) - q:
            end = at
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(shortest, 2 * q):
                smallest.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e - s, q) for (s, e), q in smallest.items()), key=lambda run: (run[0], run[2]))


def expected(words, shortest=12):
    found = brute(words, shortest)
    dropped = {at for s, n, q in found for at in range(s + q, s + n)}
    best = min(found, key=lambda run: (-run[1], run[0], run[2])) if found else (None, None, None)
    lines = b"".join(b"%d,%d,%d\n" % run for run in found)
    return len(found), *best, lines, b" ".join(w for at, w in enumerate(words) if at not in dropped)


pieces = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9))
texts = st.lists(pieces, max_size=6).map(lambda some: [w.encode() for piece, times in some for w in piece * times])


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5), st.sampled_from([12, 12, 2, 5]))
def test_runs_match_brute_force(some, shortest):
    assert runs.rows_of(some, shortest) == [expected(words, shortest) for words in some]


def test_no_run_reaches_into_the_next_text():
    assert [row[0] for row in runs.rows_of([[b"a"] * 6, [b"a"] * 6, [b"a"] * 12])] == [0, 0, 1]


def test_hash_collisions_are_noticed(monkeypatch):
    first, second = ([b"%d" % (k + start) for k in range(13)] for start in (0, 100))
    words = first + first + second + first + second + second + first
    fine, tried = runs.Hashes.same, []

    def broken(self, a, b, length):
        tried.append(self.attempt)
        return fine(self, a, b, length) if self.attempt else length > 0

    monkeypatch.setattr(runs.Hashes, "same", broken)
    assert runs.rows_of([words]) == [expected(words)]
    assert max(tried) > 0


@pytest.mark.parametrize("words", [[b"a"] * 50_000, [b"%d" % (k % 997) for k in range(50_000)],
                                   [b"%d" % (k * k % 10_007) for k in range(50_000)]])
def test_long_texts_are_taken_whole(words):
    row = runs.rows_of([words + [b"!"] + words[::-1]])[0]
    assert row[0] >= 1 and row[2] >= 40_000


def test_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert runs.rows_of([b], 2) == [expected(b, 2)]


def test_planted_change():
    doc_id = next(d for d in range(10_000) if zlib.crc32(str(d).encode()) % 10 == 0)
    words = [b"%d" % k for k in range(100)]
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % 100
    p = 1 + (100 - a) // (3 + g % 8)
    assert runs.planted(doc_id, words) == words[:a] + [words[a + (i - a) % p] for i in range(a, 100)]
    assert runs.planted(doc_id, []) == [] and runs.planted(None, words) == words


def test_query_matches_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_runs(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = runs.planted(doc.doc_id, (doc.text or "").encode().split())
        if len(words) > 3000:
            continue
        n, start, length, period, lines, collapsed = expected(words)
        r = got[doc.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (n, start, length, period)
        assert r.exponent_milli == (None if not n else 1000 * length // period)
        assert r.runs_sha256 == hashlib.sha256(lines).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, "x", 0), (None, "a " * 12, None, 1), (2, "", None, None), (2, "a " * 12, "y", 2),
            (2, "a " * 12, "y", 2), (3, "a b " * 7 + "\u0085", "z", 3), (4, "\t\r\n \x0b\x0c", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start long")
    got = sorted(map(tuple, runs.detect(docs).select("doc_id", "n_runs", "start", "length", "period", "collapsed").collect()),
                 key=repr)
    assert got == sorted([(1, 0, None, None, None, ""), (None, 1, 0, 12, 1, "a"), (2, 0, None, None, None, ""),
                          (2, 1, 0, 12, 1, "a"), (2, 1, 0, 12, 1, "a"),
                          (3, 0, None, None, None, "a b " * 7 + "\u0085"), (4, 0, None, None, None, "")], key=repr)
    assert runs.digests(docs.limit(0)).collect() == []


def test_result_does_not_depend_on_the_slice():
    rnd = random.Random(5)
    some = [[b"%d" % rnd.randrange(3) for _ in range(rnd.randrange(80))] * rnd.randrange(1, 4) for _ in range(40)]
    assert runs.rows_of(some) == [runs.rows_of([words])[0] for words in some]
