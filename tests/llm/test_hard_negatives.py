"""Hard negatives against plain Python and SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from larder.llm import hard_negatives, queries

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchors, positives=5, negatives=5):
    usable = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
              if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = set()
    result = []
    for anchor, label, vector in usable:
        if anchor not in anchors or (anchor, label, tuple(vector)) in found:
            continue
        found.add((anchor, label, tuple(vector)))
        scored = sorted((-max(-2**55, min(2**55, sum(x * y for x, y in zip(vector, v)))), i, l) for i, l, v in usable)
        for below, positive, _ in [s for s in scored if s[2] == label and s[1] != anchor][:positives]:
            fits = [s for s in scored if s[2] != label and 80 * -below <= 100 * -s[0] <= 100 * -below][:negatives]
            result += [(anchor, positive, rank, i, -below, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(result)


def mined(spark, rows, is_anchor, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in hard_negatives.mine(df, is_anchor, **more).collect())


@pytest.mark.parametrize("seed", range(4))
def test_matches_plain_python(spark, seed):
    rnd = random.Random(seed)
    # Few values make many equal scores; every third vector is close to one of three others.
    centres = [[rnd.choice([-1, 0, 1]) / 2 for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(300):
        vector = [c + rnd.choice([0, 0, 0.01, -0.01]) for c in rnd.choice(centres)]
        rows.append((i, rnd.randrange(3), vector))
    got = mined(spark, rows, F.col("vec_id") % 20 == 0)
    assert got == brute(rows, set(range(0, 300, 20))) and got


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.5]), (1, 1, [0.5, 0.5]), (2, None, [1.0, 0.0]),
            (3, 2, None), (4, 2, [None, 1.0]), (5, 2, [float("nan"), 0.0]), (6, 2, [float("inf"), 0.0]),
            (7, 2, [0.49, 5.0]), (7, 2, [0.49, 5.0]), (8, 2, [0.45]), (9, 2, [0.5, 0.0, 9.0]), (10, 2, []), (None, 2, [0.5, 0.0]),
            (11, 1, [-0.5, 0.0]), (12, 1, [0.0, 1.0])]
    got = mined(spark, rows, F.col("vec_id") == 0)
    assert got == brute(rows, {0})
    assert {r[1] for r in got} == {1, 12} and {r[3] for r in got if r[1] == 1} == {7, 8, 9}


def test_great_components_stay_exact(spark):
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [2e6, 0.5]), (2, 2, [2e6, 0.25]), (3, 2, [2e6, 0.5]), (4, 1, [1e30, 1.0]),
            (5, 2, [1e300, -1.0]), (6, 2, [1.9e6, 0.0])]
    assert mined(spark, rows, F.col("vec_id") == 0) == brute(rows, {0})


def test_blocks_give_the_same_rows(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randrange(4), [rnd.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    whole = mined(spark, rows, F.col("vec_id") % 5 == 0)
    assert mined(spark, rows, F.col("vec_id") % 5 == 0, block_bytes=8 * 8 * 16) == whole
    assert whole == brute(rows, set(range(0, 200, 5)))


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("vec_id") == 0).collect() == []
    rows = spark.createDataFrame([(1, 1, [1.0])], SCHEMA)
    assert hard_negatives.mine(rows, F.col("vec_id") == 0).collect() == []
    more = spark.createDataFrame([(0, 1, [1.0], 5, "x"), (1, 1, [1.0], 6, "y"), (2, 2, [1.0], 7, "z")],
                                 SCHEMA + ", anchor long, score string")
    assert [tuple(r) for r in hard_negatives.mine(more, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2, 65536, 65536)]


def test_query_matches_sql(spark):
    result = queries.op11_hard_negatives(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    cursor = con.execute(queries.oracle_sql()["op11_hard_negatives"])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert compare.canonical(result.columns, result.collect()) == compare.canonical(columns, cursor.fetchall())
