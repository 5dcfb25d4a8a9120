"""The pipeline against its stages done by brute force, and as registered."""

import os
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from larder.llm import bpe, line_quality, packing, pii
from larder.sources.tables import shared_folder
from test_bpe_and_packing import check_packing
from test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, results = docs.columns, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert number == 4 or docs.columns == columns
        results.append([r.asDict() for r in docs.collect()])
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    clean = {d: line_quality.judge(t or "") for d, t in given.items()}
    cleaned = {d: text for d, (values, text) in clean.items() if values[-1]}
    assert {r["doc_id"]: r["text"] for r in results[0]} == cleaned
    assert all(r["n_chars"] == len(r["text"]) for r in results[0])
    last = {}
    for d, text in sorted(cleaned.items()):
        last[text] = d
    exact = {d: t for t, d in last.items()}
    assert {r["doc_id"]: r["text"] for r in results[1]} == exact
    prints = {d: brute_fingerprint(t) for d, t in exact.items()}
    component = brute_components(prints.values())
    first = {}
    for d in sorted(prints):
        first.setdefault(component[prints[d]], d)
    assert sorted(r["doc_id"] for r in results[2]) == sorted(first.values())
    known = {r["doc_id"]: r["text"] for r in results[2]}
    written = {r["doc_id"]: r["text"] for r in results[3]}
    assert set(known) == set(written)
    entity = spark.createDataFrame(list(known.items()), "doc_id long, text string").filter(F.col("text").rlike(pii.PATTERN))
    marked = {r["doc_id"] for r in entity.collect()}
    assert all(known[d] == written[d] for d in known if d not in marked)
    check_packing(list(written.items()), docs.collect(), packing.CAPACITY)


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    # Only the result itself is left of what the stages have written.
    assert [name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before] == ["packing"]
    assert rows and max(Counter(r["sequence_id"] for r in rows).values()) >= 1
    assert bpe.default_path()
