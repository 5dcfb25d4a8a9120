"""Line-first cleaning against SQL on the tables and against plain counting on odd texts."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from larder.llm import line_quality as lq

TEXTS = [None, "", " \n\t", "one two", "a b c d e " * 4, "x y z w v u x y z w v u",
         "Plain words stand here in one long line that ends well.\nAll rights reserved.\nMore plain words stand here, too.",
         "\n".join(["same line of words"] * 3), "Bad*** words&&& all### over%%% this$$$ line*** and&&& on###",
         "home | about | shop | news | help | more | jobs | press | legal | end", "NOW!! BUY!! THIS!! " * 5,
         "\xa0nbsp is no space here", "so so so it it it goes goes on on and on " * 2, "w" * 200000, "word " * 50000]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_measures(text):
    values, _ = lq.judge(text or "")
    want = brute(text)
    assert values[:5] == want
    assert values[7] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def fails(line):
    return lq.line_fails(line, line.encode().split())


def test_rules():
    assert fails("Bad*** words&&&") and fails("A!! B!!")
    assert fails("home | about | shop") and fails("© 2020 All Rights Reserved.")
    assert fails("one one one two two two")
    assert not fails("A plain line, with words (and a price of $5) in it.")
    assert not lq.judge(TEXTS[8])[0][-1] and not lq.judge(TEXTS[9])[0][-1]
    values, left = lq.judge(TEXTS[6])
    assert values[-1] and "rights" not in left and left.count("\n") == 1


def test_rows_and_columns(spark):
    rows = [(i if i else None, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("extra"))
    measured = lq.measure(docs).collect()
    assert len(measured) == len(rows)
    kept = lq.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [6, 6, 11] or sorted(r["doc_id"] for r in kept.collect()) == [6, 6]
    assert lq.measure(docs.limit(0)).collect() == [] and lq.clean(docs.limit(0)).collect() == []


def test_sql_agrees(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:13])], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(lq.sql())
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(dict(zip(names, row)).items()) for row in cursor.fetchall())
    got = sorted(tuple((n, r[n]) for n in names) for r in lq.measure(docs).collect())
    assert got == want
