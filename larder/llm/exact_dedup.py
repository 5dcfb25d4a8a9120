"""Exact dedup against a history that is indexed by a minimal perfect hash.

The distinct SHA-256 digests of the history are spread over shards. Each shard holds a minimal perfect hash
(hash and displace): as many slots as digests, and in each slot the full digest, the winner (the largest
doc_id so far) and the number of rows. A new digest is hashed to its one slot and compared with the 32 bytes
there; a match joins the slot's group, a non-member makes a group of its own.

Results for odd input: a null text is the empty text. A null id is smaller than any other; where all rows of
a group have null ids, keep_id is null and `kept` is true for them. Rows that repeat id and text are all
marked alike; `distinct_rows` leaves one of them. An empty history or an empty input gives an empty index or
result. Other columns are ignored by `resolve` and carried by `distinct_rows`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.tables import staged

DIGEST_BYTES = 32
SHARD_DIGESTS = 8192
# Digests per displacement value.
BUCKET_DIGESTS = 4
# Displacements tried at once.
TRIES = 64
LOWEST_ID = -(1 << 63)

INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("displacements", T.BinaryType()),
    T.StructField("digests", T.BinaryType()), T.StructField("winners", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),
])
GROUPS = T.StructType([
    T.StructField("digest", T.BinaryType()), T.StructField("winner", T.LongType()),
    T.StructField("size", T.LongType()),
])


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, as bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _mixed(words: np.ndarray, displacement: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of each digest (rows of four words) for a displacement."""
    step = np.asarray(displacement, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    value = words[..., 2] + step
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= words[..., 3]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(32))


def _buckets(words: np.ndarray, n: int) -> np.ndarray:
    return (words[:, 1] % np.uint64(max(1, n // BUCKET_DIGESTS))).astype(np.int64)


def build(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of every bucket, and the slot of every digest, for distinct digests (n rows of 4 words).

    A bucket of one digest stores its slot as a negative number; others store the first displacement that
    puts all their digests into free slots."""
    n = len(words)
    bucket = _buckets(words, n)
    displacements = np.zeros(max(1, n // BUCKET_DIGESTS), np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if n else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n]
    taken, slots = np.zeros(n, bool), np.zeros(n, np.int64)
    by_size = np.argsort(starts - ends, kind="stable")
    singles = []
    for at in by_size:
        rows = order[starts[at]:ends[at]]
        if len(rows) == 1:
            singles.append(rows[0])
            continue
        base = 0
        while True:
            tried = np.arange(base, base + TRIES, dtype=np.uint64)
            places = (_mixed(words[rows][None], tried[:, None]) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(places, axis=1)
            fits = ~taken[places].any(axis=1) & (np.diff(ordered, axis=1) != 0).all(axis=1)
            if fits.any():
                first = int(np.argmax(fits))
                break
            base += TRIES
        displacements[bucket[rows[0]]] = base + first
        slots[rows] = places[first]
        taken[places[first]] = True
    free = np.flatnonzero(~taken)
    slots[singles] = free
    displacements[bucket[singles]] = -1 - free
    return displacements, slots


def lookup(words: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    """The one slot in which each digest can be."""
    shift = displacements[_buckets(words, n)]
    hashed = (_mixed(words, np.maximum(shift, 0)) % np.uint64(n)).astype(np.int64)
    return np.where(shift < 0, -1 - shift, hashed)


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, digests)), "<u8").reshape(-1, DIGEST_BYTES // 8)


def _per_digest(rows: DataFrame, shards: int) -> DataFrame:
    """Winner and number of rows of each distinct digest, and its shard."""
    return rows.groupBy("digest").agg(F.max(F.coalesce("doc_id", F.lit(LOWEST_ID))).alias("winner"),
                                      F.count(F.lit(1)).alias("size")) \
        .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index of a history (doc_id, digest): one row per shard, written to the shared folder."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        words = _words(frame["digest"])
        displacements, slots = build(words)
        placed = np.empty_like(slots)
        placed[slots] = np.arange(len(slots))
        return pd.DataFrame({
            "shard": [frame["shard"].iloc[0]], "displacements": [displacements.tobytes()],
            "digests": [words[placed].tobytes()],
            "winners": [frame["winner"].to_numpy(np.int64)[placed].tobytes()],
            "sizes": [frame["size"].to_numpy(np.int64)[placed].tobytes()],
        })

    return staged(_per_digest(history, shards).groupBy("shard").applyInPandas(run, INDEX), "digest_index")


def resolve_digests(new: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Every digest of history and new rows with the winner and size of its group over both."""

    def run(frame: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        winners, sizes = frame["winner"].to_numpy(np.int64), frame["size"].to_numpy(np.int64)
        if not len(entry):
            return frame[["digest", "winner", "size"]]
        held = entry.iloc[0]
        words = np.frombuffer(held["digests"], "<u8").reshape(-1, DIGEST_BYTES // 8)
        best = np.frombuffer(held["winners"], np.int64).copy()
        count = np.frombuffer(held["sizes"], np.int64).copy()
        asked = _words(frame["digest"]) if len(frame) else np.zeros((0, DIGEST_BYTES // 8), np.uint64)
        slot = lookup(asked, np.frombuffer(held["displacements"], np.int64), len(words))
        member = (words[slot] == asked).all(axis=1)
        # Digests are distinct here, so a slot is met at most once.
        best[slot[member]] = np.maximum(best[slot[member]], winners[member])
        count[slot[member]] += sizes[member]
        known = pd.DataFrame({"digest": [row.tobytes() for row in words], "winner": best, "size": count})
        return pd.concat([known, frame.loc[~member, ["digest", "winner", "size"]]], ignore_index=True)

    grouped = _per_digest(new, shards).groupBy("shard").cogroup(index.groupBy("shard"))
    return grouped.applyInPandas(run, GROUPS)


def resolve(docs: DataFrame, is_history: Column) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `is_history` says which rows the index is built over; null means no."""
    rows = staged(docs.select("doc_id", digest_of(F.col("text")).alias("digest"),
                              F.coalesce(is_history, F.lit(False)).alias("old")), "digests")
    old, new = (rows.filter(c).select("doc_id", "digest") for c in (F.col("old"), ~F.col("old")))
    shards = 1 + rows.agg(F.approx_count_distinct("digest")).first()[0] // SHARD_DIGESTS
    groups = resolve_digests(new, build_index(old, shards), shards)
    keep = F.when(F.col("winner") != LOWEST_ID, F.col("winner"))
    return rows.drop("old").join(groups, "digest").select(
        "doc_id", keep.alias("keep_id"), F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def first_half(docs: DataFrame) -> Column:
    """Whether a row's id lies in the lower half of the table's id range: the earlier delivery."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.lit(False) if low is None else F.col("doc_id") <= F.lit((low + high) // 2)


def distinct_rows(docs: DataFrame, is_history: Column) -> DataFrame:
    """The winners, in the columns of `docs`; of rows that repeat id and text, one.

    Only rows that share id and text with another are shuffled with their text."""
    kept = staged(resolve(docs, is_history).filter("kept").groupBy("doc_id", "text_sha256")
                  .agg(F.count(F.lit(1)).alias("times")), "winners")
    mine = [docs["doc_id"].eqNullSafe(kept["doc_id"]),
            F.sha2(F.coalesce(docs["text"], F.lit("")), 256) == kept["text_sha256"]]
    single = docs.join(kept.filter("times = 1"), mine, "left_semi")
    again = docs.join(kept.filter("times > 1"), mine, "left_semi")
    one = again.withColumn("text", F.coalesce("text", F.lit(""))).dropDuplicates(["doc_id", "text"])
    return single.unionByName(one.select(docs.columns))


def sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
