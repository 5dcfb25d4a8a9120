"""Language of pages: held-out accuracy, the use of each kind of evidence, odd pages."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import langid, queries

DATA = "/root/testdata/sf0.01"


def truth(spark):
    pages, docs = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("pages", "documents"))
    of_page = pages.select("page_id", F.regexp_extract("url", r"/(\d+)", 1).cast("long").alias("doc_id"))
    return of_page.join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id")


def test_whole_table(spark):
    got = queries.op9_language(spark, DATA)
    assert got.count() == spark.read.parquet(f"{DATA}/pages.parquet").count()
    assert got.join(truth(spark), "page_id").filter("lang <> truth").count() == 0


def test_held_out_accuracy_without_markup_or_links(spark):
    pages, docs = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("pages", "documents"))
    known = truth(spark)
    seen = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    bare = pages.withColumn("html", F.regexp_replace("html", 'lang="..?"', ""))
    new = langid.identify(bare, seen).join(known, "page_id").filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    assert new.count() > 50 and new.filter("lang <> truth").count() <= 0.02 * new.count()


def test_host_and_markup_decide_where_text_is_silent(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {lang: docs.filter((F.col("lang") == lang) & (F.length("text") > 500)).first()["text"] for lang in ("de", "fr")}
    rows = [(i, f"http://a.example.{lang}/{i}", f"<html lang='{lang}'><p>{text[lang]}</p>") for lang in text for i in range(30)]
    rows += [(100, "http://a.example.de/x", "<p>1 2 3</p>"), (101, "http://a.example.fr/x", "<p></p>"),
             (102, "http://other.org/x", "<html lang=fr>"), (103, "http://other.net/x", '<HTML class="x" LANG="DE-at">')]
    got = {r["page_id"]: r for r in langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert [got[i]["lang"] for i in (100, 101, 102, 103)] == ["de", "fr", "fr", "de"]
    assert got[101]["text_lang"] is None and got[103]["declared"] == "de"


def test_visible_text():
    page = "<html><script>var a = '<p>no</p>';</script><nav>no</nav><!-- no --><p>yes &amp; <b>more</b></p><footer>no</footer>"
    assert langid.visible_text(page).split() == ["yes", "&", "more"]


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(1, None, None), (2, "", "<html lang=fr>"), (2, "", "<html lang=fr>"), (None, "http://x.de/", "<p>" + "und der " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = langid.identify(pages, docs).collect()
    assert len(got) == 4 and all(0 < r["confidence"] <= 1 for r in got)
    assert langid.identify(pages.limit(0), docs).collect() == []
    assert {r["lang"] for r in langid.identify(pages, docs.limit(0)).collect()} == {None}


@pytest.mark.parametrize("markup", ["<nav>x " * 150_000, "<!-- x " * 150_000, "<html " * 150_000, "<html lang" * 100_000,
                                    '<div class="ad">x' * 60_000, "<script>x" * 100_000, "<html" + " lang" * 200_000])
def test_a_megabyte_of_open_tags_takes_no_time(markup):
    start = time.perf_counter()
    langid.visible_text(markup)
    langid.declared_language(markup)
    assert time.perf_counter() - start < 2


def test_declared_language():
    for markup, want in (("<html lang=fr>", "fr"), ('<HTML class="x" LANG="DE-at">', "de"), ("<html><p lang=de>", ""),
                         ("<htmlx lang=de>", ""), ("<html data-lang=de>", ""), ("<html lang='english'>", ""), ("", "")):
        assert langid.declared_language(markup) == want


def brute(pages, languages, table):
    """The fused language of every page by plain loops over all pages."""
    read = []
    for page, url, markup in pages:
        found = langid.trigrams(langid.visible_text(markup))
        score = table[:, found].mean(axis=1) * min(len(found), langid.TEXT_WEIGHT) if len(found) else np.zeros(len(languages))
        chance = np.exp(score - score.max())
        host = url.split("://")[1].split("/")[0].lower()
        read.append((page, host, ".".join(host.split(".")[-2:]), host.split(".")[-1], langid.declared_language(markup),
                     score, chance / chance.sum()))
    whole = sum(r[6] for r in read)
    everywhere = (whole + 1) / (whole.sum() + len(languages))
    result = {}
    for row in read:
        page, host, domain, suffix, declared, score, own = row
        near = [sum((r[6] for r in read if r[k] == row[k] and r is not row), np.zeros(len(languages))) for k in range(1, 5)]
        prior = (near[1] + langid.DOMAIN_STRENGTH * everywhere) / (near[1].sum() + langid.DOMAIN_STRENGTH)
        prior = (near[0] + langid.HOST_STRENGTH * prior) / (near[0].sum() + langid.HOST_STRENGTH)
        fused = score + np.log(prior)
        for k, used in ((2, True), (3, declared != "")):
            kinds = len({r[k + 1] for r in read})
            if used:
                fused = fused + np.log((near[k] + langid.TABLE_STRENGTH / kinds) / (whole - own + langid.TABLE_STRENGTH))
        chance = np.exp(fused - fused.max())
        result[page] = (languages[int(fused.argmax())], chance.max() / chance.sum())
    return result


def test_fusion_matches_plain_loops(spark):
    pages, docs = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("pages", "documents"))
    languages, table = langid.train(docs)
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    rows += [(-1, "http://only.one.suffix/x", "<p>1 2</p>"), (-2, "http://a.example.de/", "<html lang=xx>")]
    want = brute(rows, languages, table)
    got = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.confidence == pytest.approx(want[r.page_id][1], rel=1e-4)
        assert r.lang == want[r.page_id][0] or r.confidence < 0.51
