"""Exact dedup: the minimal perfect hash, and groups against plain grouping."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import exact_dedup


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 500, 20000])
def test_hash_is_minimal_and_perfect(n):
    words = np.random.default_rng(n).integers(0, 2**63, (n, 4), dtype=np.uint64)
    displacements, slots = exact_dedup.build(words)
    assert sorted(slots) == list(range(n))
    assert n == 0 or (exact_dedup.lookup(words, displacements, n) == slots).all()


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    found = []
    for doc, text in rows:
        same = groups[text or ""]
        keep = max((d for d in same if d is not None), default=None)
        found.append((doc, keep, len(same), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(found, key=repr)


ROWS = [(1, "a"), (2, "a"), (9, "b"), (3, None), (4, ""), (None, "a"), (None, "n"), (None, "n"), (7, "z" * 300000),
        (8, "z" * 300000), (5, "é"), (5, "é"), (6, "é")]


@pytest.mark.parametrize("history", ["doc_id <= 3", "false", "true", "doc_id % 2 = 0", "cast(null as boolean)"])
def test_groups_do_not_depend_on_the_history(spark, history):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("digest", F.lit(0))
    got = exact_dedup.resolve(docs, F.expr(history))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ROWS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.resolve(docs, exact_dedup.first_half(docs)).collect() == []
    assert exact_dedup.distinct_rows(docs, exact_dedup.first_half(docs)).collect() == []


def test_distinct_rows_leave_one_of_each(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("times", F.lit("extra"))
    left = exact_dedup.distinct_rows(docs, exact_dedup.first_half(docs))
    assert left.columns == docs.columns
    want = [(2, "a"), (4, ""), (5, "é"), (6, "é"), (8, "z" * 300000), (9, "b"), (None, "n")]
    assert sorted(((r["doc_id"], r["text"] or "") for r in left.collect()), key=repr) == sorted(want, key=repr)
