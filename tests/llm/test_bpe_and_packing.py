"""Encoding against the public library, decoding, and packing against its own rules and best fit."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from larder.llm import bpe, packing, queries
from larder.llm.common import map_texts, text_slices, texts

SMALL = "/root/testdata/sf0.001"
PATH = bpe.default_path()
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.WordBpe(PATH)
ODD = ["", " \t\n", "a<|endoftext|>b <|startoftext|>X <|endoftext", "İSTANBUL ΣΑΣ Σ", "é ́x a\xa0b\x85c\x1cd", "DON'T 12a3 ½²٣",
       "ẞ ﬁ Å Å \U0001F600 한국어 中文字 क्षि", "aaaaaaaa lolololo", " ", "x" * 50000, "\x00 ퟿ �"]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(OWN.encode([text])[0], "<i4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_encode_as_the_library(text):
    assert own_ids(text) == library_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text_encodes_as_the_library(text):
    assert own_ids(text) == library_ids(text)


def test_forgetting_changes_nothing(monkeypatch):
    few, little = bpe.WordBpe(PATH), bpe.WordBpe(PATH, most_bytes=1000)
    few._known.limit = 3
    texts = ["one two three four", "two five six", "one seven eight two", "nine ten one", "w" * 3000] * 3
    for small in (few, little):
        for _ in range(3):
            assert [np.frombuffer(i, "<i4").tolist() for i in small.encode(texts)] == [library_ids(t) for t in texts]


def test_a_worker_remembers_a_bounded_number_of_bytes():
    small = bpe.WordBpe(PATH, most_bytes=100_000)
    for start in range(0, 20_000, 500):
        small.encode([" ".join(f"word{i}x{i * 7}" for i in range(start, start + 500)) + " " + "y" * start])
        held = [sum(len(k) + len(v) + bpe.ENTRY_BYTES for k, v in some.items())
                for some in (small._known, small._known.older, small._known_pieces)]
        # Each may go over its bound by what one slice of texts adds.
        assert max(held) <= 100_000 + 500 * (bpe.ENTRY_BYTES + 60) + 8 * start + 1000


def test_packing_is_forgotten_when_other_work_begins(spark):
    docs = spark.range(0, 64, 1, 8).selectExpr("id AS doc_id", "concat('word', id, ' more text') AS text")
    assert packing.pieces(docs, PATH).count() == 64

    def held(batch):
        ids = packing.library_ids(PATH)
        return pa.RecordBatch.from_arrays([pa.array([len(ids._known) + len(ids._known.older) + len(ids._known_pieces)])], ["held"])

    found = map_texts(docs, held, T.StructType([T.StructField("held", T.LongType())])).collect()
    assert {r["held"] for r in found} == {0}


def test_an_encoder_remembers_in_its_own_tasks_alone():
    mine, other = bpe.WordBpe(PATH), bpe.WordBpe(PATH)
    batch = pa.RecordBatch.from_arrays([pa.array(["one two", None])], ["text"])
    for encoder, kept in ((mine, True), (mine, True), (other, False), (None, False)):
        for part in text_slices(iter([batch]), encoder=encoder):
            if encoder:
                encoder.encode(texts(part))
        assert bool(mine._known) == bool(mine._known_pieces) == kept
    assert not other._known


def brute_digest(doc, text):
    ids = library_ids(text or "")
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), decoded)]
    return (doc, len(ids), *sha)


def test_bpe_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op10_bpe(spark, SMALL).collect())
    assert got == sorted(brute_digest(*r) for r in rows)


def test_bpe_odd_rows(spark):
    rows = [*enumerate(ODD), (None, None), (3, "same"), (3, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((tuple(r) for r in bpe.digests(docs, PATH).collect()), key=repr)
    assert got == sorted((brute_digest(*r) for r in rows), key=repr)
    assert bpe.digests(docs.limit(0), PATH).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.with_decoded(nothing, PATH).collect()] == ["", ""]


def check_packing(rows, packed, capacity):
    want = []
    for doc, text in rows:
        ids = [*library_ids(text or ""), 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            want.append((doc, piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted((tuple(r[:5]) for r in packed), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in sequences.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit(lengths, capacity):
    rooms, used = Counter(), 0
    for size in sorted(lengths, reverse=True):
        room = next((r for r in range(size, capacity + 1) if rooms[r]), None)
        if room is None:
            used, room = used + 1, capacity
        else:
            rooms[room] -= 1
        rooms[room - size] += 1
    return used


def test_packing_query_keeps_every_id(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    packed = queries.op8_packing(spark, SMALL).collect()
    used = check_packing(rows, packed, 2048)
    assert used <= 1.01 * best_fit([r["length"] for r in packed], 2048) + 1


def test_packing_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "word " * 20), (3, "x " * 100), (4, "y " * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    check_packing(rows, packing.pack(docs, PATH, 16).collect(), 16)
    assert packing.pack(docs.limit(0), PATH, 16).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([16, 100, 2048]))
    lengths = np.clip(rng.lognormal(np.log(capacity * 0.3), 1, int(rng.choice([0, 1, 300, 5000]))).astype(int), 1, capacity)
    numbers = {int(a): int(b) for a, b in Counter(lengths.tolist()).items()}
    placed, used = defaultdict(list), 0
    for times, slots in packing.plan(numbers, capacity):
        assert times > 0 and slots and sum(s for s, _ in slots) <= capacity
        used += times
        for size, first in slots:
            placed[size].append((first, first + times))
    for size, n in numbers.items():
        spans = sorted(placed[size])
        assert spans[0][0] == 0 and spans[-1][1] == n
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert used <= 1.02 * best_fit(lengths.tolist(), capacity) + 1
