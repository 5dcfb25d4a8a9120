"""URL filter against its SQL, its rules against plain Python, and odd URLs."""

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from larder.llm import queries, url_filter

SMALL = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "nourl"), (4, "http://A.Org/fr/x"), (4, "http://A.Org/fr/x"), (5, "ftp://x.NET"), (6, "http://example.net/en/?q#f"),
       (7, "http://é.com/\n://b"), (None, "https://sub.example.com/de/1"), (8, "http://notexample.com/de/"), (9, "x://net/" + "a" * 5000)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    cursor = con.execute(url_filter.sql())
    names, rows = [d[0] for d in cursor.description], cursor.fetchall()
    got = queries.op4_url_filter(spark, SMALL)
    assert compare.canonical(got.columns, got.collect()) == compare.canonical(names, rows)


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_rules_on_odd_urls(spark):
    pages = spark.createDataFrame(ODD, "page_id long, url string")
    got = sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in url_filter.judge(pages).collect())
    assert len(got) == len(ODD)
    for (page, url), row in zip(sorted(ODD, key=lambda r: (r[0] or 0, r[1] or "")), got):
        host, path, rule, verdict = brute_rule(url)
        assert row[:4] == (page or 0, host, path, rule or "") and row[4] in ((verdict,) if verdict else ("allow", "block"))
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_models_tell_spam_from_others(spark):
    rows = [(i, f"http://{'cheap' if i % 2 else 'garden'}-{i}.{'net' if i % 2 else 'org'}/fr/{i}") for i in range(200)]
    rows += [(1000 + i, f"http://{'cheap' if i % 2 else 'garden'}-{i}.info/fr/{i}") for i in range(20)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).filter("page_id >= 1000").collect()
    assert {(r["page_id"] % 2, r["verdict"]) for r in got} == {(0, "allow"), (1, "block")}


def test_both_joins_agree(spark, monkeypatch):
    rows = ODD + [(100 + i, f"http://{'cheap' if i % 2 else 'garden'}-{i}.{'net' if i % 2 else 'org'}/fr/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    found = []
    for most in (0, 100_000):
        monkeypatch.setattr(url_filter, "BROADCAST_WINDOWS", most)
        result = url_filter.judge(pages)
        assert result.columns.count("host") == 1
        found.append(sorted((repr(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"], round(r["score"], 9)) for r in result.collect()))
    assert len(found[0]) == len(rows) and found[0] == found[1]
