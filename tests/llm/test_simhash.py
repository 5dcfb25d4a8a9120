"""SimHash fingerprints, the bit-sliced comparison and the components, against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import queries, simhash

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [words[i:i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """fingerprint -> smallest one of its component."""
    values = np.array(sorted(set(prints)), np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(values))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return {int(v): int(i) for v, i in zip(values, label)}
        label = new


def expected(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    component = brute_components(prints)
    smallest = {}
    for (doc, _), p in zip(rows, prints):
        if doc is not None:
            smallest[component[p]] = min(doc, smallest.get(component[p], doc))
    return sorted(((doc, f"{p:016x}", smallest.get(component[p])) for (doc, _), p in zip(rows, prints)), key=repr)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_carry_save_counts(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    other = base.copy()
    for _ in range(radius + 1):
        other ^= np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
    assert (simhash.near_pairs(base ^ other, radius) == (np.bitwise_count(base ^ other) <= radius)).all()
    exact = np.bitwise_count(base[:, None] ^ other[None, :]) <= radius
    assert (simhash.near_matrix(base, other, radius) == exact).all()


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op3_simhash(spark, SMALL).collect()), key=repr)
    assert got == expected(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c d"), (5, None), (7, ""), (3, " \t\n"), (9, "One two"), (9, "one TWO"), (2, "x " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash"))
    got = sorted((tuple(r) for r in simhash.groups(docs).collect()), key=repr)
    assert got == expected(rows)
    assert simhash.groups(docs.limit(0)).collect() == []


def test_large_groups_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(4)
    start = int(rng.integers(0, 2**62))
    values = {start ^ int(rng.integers(0, 2**9)) << 40 for _ in range(300)} | set(map(int, rng.integers(0, 2**62, 300)))
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    found = simhash.components(simhash.links(frame, 3)).collect()
    root = {r["node"] & (2**64 - 1): r["root"] for r in found}
    label = brute_components(values)
    sizes = {i: list(label.values()).count(i) for i in label.values()}
    assert set(root) == {v for v in values if sizes[label[v]] > 1}
    assert len({(root[v], label[v]) for v in root}) == len({root[v] for v in root}) == len({label[v] for v in root})


def test_one_row_of_a_component_stays(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(4, text), (2, text), (2, text), (8, text + " end"), (6, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.distinct_rows(docs).collect()) == [2, 6]


def test_one_row_of_every_component_stays_without_or_with_shared_ids(spark):
    clean = [" ".join(f"{c}{i}" for i in range(400)) for c in "wabcd"]
    assert len(set(brute_components(map(brute_fingerprint, clean)).values())) == 5

    def kept(rows):
        return sorted(map(tuple, simhash.distinct_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)

    near = (None, clean[0] + " end")
    want = [(5, clean[0]), (None, clean[1]), (None, clean[2]), (3, clean[3]), (3, clean[4])]
    assert kept([*want, near, (None, clean[2])]) == sorted(want, key=repr)
    assert kept([want[0], want[1], near]) == sorted(want[:2], key=repr)
    assert kept([(None, None), (None, None)]) == [(None, None)]


def test_a_radius_beyond_three_is_refused(spark):
    with pytest.raises(ValueError, match="0 to 3"):
        simhash.near_pairs(np.zeros(3, np.uint64), 4)
    with pytest.raises(ValueError, match="0 to 3"):
        simhash.groups(spark.createDataFrame([(1, "a")], "doc_id long, text string"), radius=4)


def test_a_hot_node_is_split(spark):
    """A star of many links: the rows of its centre are spread over tasks where they meet its smallest neighbour."""
    star = simhash.staged(spark.range(1, 4001).selectExpr("0L AS a", "id AS b"), "star")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        least = simhash._by_minimum(star, "a", "b")
        met = star.join(least, star["a"] == least["n"])
        met.collect()
        assert "skew=true" in met._jdf.queryExecution().executedPlan().toString()
        assert {r.root for r in simhash.components(star).collect()} == {0}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
