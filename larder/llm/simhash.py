"""SimHash near-duplicates: fingerprints of word shingles, linked by a bit-sliced comparison.

Distinct fingerprints are cut into five fields; two that differ in at most three bits agree in two fields at
least, so each goes under the ten pairs of fields. Fingerprints under one key are compared with their bits
stored vertically: one plane per bit position, 64 fingerprints to a machine word. Distances of many pairs are
counted at once by carry-save addition of the planes into a ones and a twos counter and an overflow mark
(more than `radius` differing bits), and a block is left as soon as every lane has overflowed. Keys with many
fingerprints are split into tiles, and each pair of tiles is a group of its own. Only a spanning forest of
each group's links is emitted.

Results for odd input: null or empty texts have fingerprint zero, which links like any other; a null id never
is a component's smallest id unless all ids are null (then the component_id is null); repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, map_texts, texts
from larder.llm.exact_dedup import digest_of
from larder.sources.tables import staged

SEED = 42
BITS = 64
# Fingerprints of one key that meet in one group at most, on average, before it is split into tiles.
TILE = 1024
# Query fingerprints compared with a tile's planes at once, and planes between two looks at the overflow.
QUERIES = 256
LOOK_EVERY = 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of the text's shingles of `words` words, repeats included; of all words where there are fewer."""
    tokens = text.encode().lower().split()
    if not tokens:
        return []
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        return [digest(b" ".join(tokens), SEED)]
    return [digest(b" ".join(s), SEED) for s in zip(*(tokens[i:] for i in range(words)))]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose hashes lie one after the other, `counts` of them each."""
    n = len(counts)
    owner = np.repeat(np.arange(n) * 256, counts)
    fingerprint = np.zeros(n, np.uint64)
    values = np.arange(256)
    for byte in range(8):
        part = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        seen = np.bincount(owner + part, minlength=256 * n).reshape(n, 256)
        for bit in range(8):
            ones = seen[:, (values >> bit) & 1 == 1].sum(axis=1)
            fingerprint |= (2 * ones > counts).astype(np.uint64) << np.uint64(8 * byte + bit)
    return fingerprint


def fingerprints(docs: DataFrame, words: int, *carried: Column) -> DataFrame:
    """doc_id, the carried columns and fingerprint (the 64 bits as a long) of every row's whole text."""
    rows = docs.select("doc_id", *carried, "text")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fingerprint", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashed = [shingle_hashes(text, words) for text in texts(batch)]
        counts = np.array([len(h) for h in hashed], np.int64)
        bits = majority_bits(np.array([x for h in hashed for x in h], np.uint64), counts)
        return pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in schema.names[:-1]), pa.array(bits.view(np.int64))],
                                          names=schema.names)

    return map_texts(rows, run, schema)


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical form: row p holds bit p of all values, 64 values to a word; padding lanes are zero."""
    lanes = -(-len(values) // BITS) * BITS
    padded = np.zeros(lanes, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def check_radius(radius: int) -> None:
    """The counters have two bits: a radius beyond 3 is refused."""
    if not 0 <= radius <= 3:
        raise ValueError(f"fingerprints are compared within 0 to 3 bits, not {radius}")


def _count(differing: Iterator[np.ndarray], shape: tuple[int, ...], radius: int) -> np.ndarray:
    """Words whose set lanes differ in at most `radius` (up to 3) of the planes.

    Carry-save: `ones` and `twos` are the two low bits of every lane's count, `over` marks lanes beyond."""
    check_radius(radius)
    ones, twos, over = (np.zeros(shape, np.uint64) for _ in range(3))
    for at, plane in enumerate(differing):
        carry = ones & plane
        ones ^= plane
        over |= twos & carry
        twos ^= carry
        if at % LOOK_EVERY == LOOK_EVERY - 1 and (over == ALL).all():
            break
    if radius == 0:
        over |= ones | twos
    elif radius == 1:
        over |= twos
    elif radius == 2:
        over |= ones & twos
    return ~over


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def near_pairs(differences: np.ndarray, radius: int) -> np.ndarray:
    """For XORs of pairs, whether each has at most `radius` bits set."""
    planes = planes_of(differences)
    return _lanes(_count(iter(planes), planes.shape[1:], radius), len(differences))


def near_matrix(queries: np.ndarray, tile: np.ndarray, radius: int) -> np.ndarray:
    """Boolean matrix: which of `tile` each query links to."""
    planes = planes_of(tile)
    found = []
    for start in range(0, len(queries), QUERIES):
        part = queries[start:start + QUERIES]
        flips = (np.uint64(0) - ((part[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)))
        differing = (planes[p][None, :] ^ flips[p][:, None] for p in range(BITS))
        found.append(_lanes(_count(differing, (len(part), planes.shape[1]), radius), len(tile)))
    return np.concatenate(found) if found else np.zeros((0, len(tile)), bool)


def forest(values: np.ndarray, sides: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, root) of the components that links inside a group make.

    With `sides`, only links between side 0 and side 1 count."""
    n = len(values)
    if sides is None:
        near = near_matrix(values, values, radius)
    else:
        near = np.zeros((n, n), bool)
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        between = near_matrix(values[left], values[right], radius)
        near[np.ix_(left, right)] = between
        near[np.ix_(right, left)] = between.T
    free = np.ones(n, bool)
    members, roots = [], []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        front = np.flatnonzero(near[root] & free)
        while len(front):
            free[front] = False
            members.append(front)
            roots.append(np.full(len(front), root))
            front = np.flatnonzero(near[front].any(axis=0) & free)
    if not members:
        return values[:0], values[:0]
    return values[np.concatenate(members)], values[np.concatenate(roots)]


def _fields(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 fields that share the 64 bits."""
    cuts = [BITS * i // (radius + 2) for i in range(radius + 3)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def keys(value: Column, radius: int) -> Column:
    """Array of keys under which a fingerprint is filed: each pair of fields, with the pair's number."""
    found = []
    for number, ((s1, w1), (s2, w2)) in enumerate(combinations(_fields(radius), 2)):
        first = F.shiftrightunsigned(value, s1).bitwiseAND(F.lit((1 << w1) - 1))
        second = F.shiftrightunsigned(value, s2).bitwiseAND(F.lit((1 << w2) - 1))
        found.append(F.shiftleft(F.lit(number).cast("long"), 58).bitwiseOR(F.shiftleft(first, w2)).bitwiseOR(second))
    return F.array(*found)


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what links of at most `radius` bits do."""
    check_radius(radius)
    filed = distinct.select("fingerprint", F.explode(keys(F.col("fingerprint"), radius)).alias("key"))
    hot = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE) \
        .select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int")
    spread = filed.join(hot, "key", "left").withColumn("mine", F.coalesce(mine, F.lit(0))).select(
        "key", "fingerprint", "mine", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles") - 1, F.lit(0)))).alias("other"))
    grouped = spread.select(
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "key",
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "fingerprint")
    order = ["key", "low", "high", "side", "fingerprint"]
    placed = grouped.repartition("group").sortWithinPartitions(*order).select(*order)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            rows = np.stack([column_of(batch, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in order], axis=1)
            if held is not None:
                rows = np.concatenate([held, rows])
            # The last group may go on in the next batch.
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            first = int(np.argmax(same)) if len(rows) else 0
            if first:
                yield _edges(rows[:first], radius)
            held = rows[first:]
        if held is not None and len(held):
            yield _edges(held, radius)

    return placed.mapInArrow(run, schema).distinct()


def _edges(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    """Edges of complete groups: pairs of small groups as lanes, others tile by tile."""
    values = np.ascontiguousarray(rows[:, 4]).view(np.uint64)
    starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(rows)])
    members, roots = [], []
    small = (rows[starts, 2] == 0) & (sizes > 1) & (sizes <= 8)
    for gap in range(1, 8):
        some = small & (sizes > gap)
        if not some.any():
            break
        spans = sizes[some] - gap
        left = np.repeat(starts[some] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())
        near = near_pairs(values[left] ^ values[left + gap], radius)
        members.append(values[left + gap][near])
        roots.append(values[left][near])
    for at in np.flatnonzero((sizes > 1) & ~small):
        span = slice(starts[at], starts[at] + sizes[at])
        cross = rows[starts[at], 1] != rows[starts[at], 2]
        # Within one tile, a row stands once; between two, each side's rows stand once.
        found = forest(values[span], rows[span, 3] if cross else None, radius)
        members.append(found[0])
        roots.append(found[1])
    a = np.concatenate(members) if members else np.zeros(0, np.uint64)
    b = np.concatenate(roots) if roots else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _by_minimum(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Smallest neighbour of every node. Written: a join of the edges with rows read from files is split at a hot node,
    one with the aggregate itself is not."""
    return staged(edges.groupBy(F.col(node).alias("n")).agg(F.min(other).alias("m")), "least")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one,
    then its smaller ones. Each step is a grouping and a join, so that a node with many neighbours is split."""
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _by_minimum(both, "a", "b").select("n", F.least("n", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")) \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = _by_minimum(large, "a", "b")
        met = large.join(least, F.col("a") == F.col("n"))
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(met.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        now = staged(small, "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    rows = staged(fingerprints(docs, words), "fingerprints")
    distinct = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints")
    linked = components(links(distinct.select("fingerprint"), radius))
    firsts = linked.join(distinct, F.col("node") == F.col("fingerprint")).select("node", "root", "first_id")
    smallest = firsts.groupBy("root").agg(F.min("first_id").alias("component"))
    named = firsts.join(smallest, "root").select(F.col("node").alias("fingerprint"), "component")
    # Written, so that both sides of the last join are shuffled for it alone and a hot fingerprint can be split.
    ids = staged(distinct.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "first_id").alias("component_id")), "components")
    return rows.join(ids, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def distinct_rows(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component, the one with the smallest id, in the columns of `docs`.

    Where different texts of a component share that id, or none has an id, the one with the smallest digest stays;
    of rows that repeat id and text, one."""
    rows = staged(fingerprints(docs, words, digest_of(F.col("text")).alias("digest")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest")).alias("first")
    distinct = staged(rows.groupBy("fingerprint").agg(first), "distinct_fingerprints")
    linked = components(links(distinct.select("fingerprint"), radius))
    chosen = distinct.join(linked, F.col("node") == F.col("fingerprint"), "left") \
        .groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("first").alias("first")).select("first.*")
    same = [rows["doc_id"].eqNullSafe(chosen["doc_id"]), rows["digest"] == chosen["digest"]]
    kept = staged(rows.join(chosen, same, "left_semi").groupBy("doc_id", "digest")
                  .agg(F.count(F.lit(1)).alias("times")), "representatives")
    match = [docs["doc_id"].eqNullSafe(kept["doc_id"]), digest_of(docs["text"]) == kept["digest"]]
    once = docs.join(kept.filter("times = 1"), match, "left_semi")
    again = docs.join(kept.filter("times > 1"), match, "left_semi")
    row = F.struct(*[again[c] for c in docs.columns]).alias("row")
    one = again.select(row, again["doc_id"].alias("id"), digest_of(again["text"]).alias("digest")).dropDuplicates(["id", "digest"])
    return once.unionByName(one.select("row.*"))
