"""Byte-pair encoding of whole texts through an index of pair occurrences, and decoding.

The vocabulary file is one of lower-cased words with a word-end mark: texts are put in NFC, white space is
folded, letters are lower-cased, a pattern cuts words, digits and symbols apart, and each piece's bytes are
merged. White space separates pieces and nothing reaches across it, so a text's ids are the ids of its
chunks between ASCII white space. A task encodes the chunks it has not met together: every adjacent pair of
symbols that has a rank is listed with all its positions, ranks are applied in ascending order, and each
merge updates the lists of the pairs it creates.

Results for odd input: null and empty texts have no ids and decode to the empty text; a chunk of other white
space has no ids; a null list of ids decodes to the empty text; repeated rows are encoded alike. A piece
without a known symbol has no ids, as in the public library. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from larder.llm.common import ENTRY_BYTES, Remembered, column_of, map_texts, texts

# Bytes of young chunks that a worker remembers; as many of older ones, and as many of pieces.
REMEMBERED_BYTES = 44 << 20
REMEMBERED_CHUNKS = 400_000
MOST_PIECE_BYTES = 80 << 20
# New chunks encoded together.
CHUNKS_AT_ONCE = 50_000
# All special tokens of the vocabulary begin so; they are the only strings in which case counts.
SPECIAL_MARK = b"<|"
SYMBOLS = ".,;:!?#*$%&|<>()[]{}\"/\\@^_`~=+-"
# From here on Unicode's letters, digits and cases depend on its version: such chunks are normalised and cut by
# the public library itself, and merged here.
FIRST_UNSURE = "\u0530"


def default_path() -> str:
    """The public vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


def _specification(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=4)
def id_names(path: str) -> pa.Array:
    """The name of every id of a vocabulary: all that decoding needs."""
    spec = _specification(path)
    named = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = [""] * (1 + max(named.values()))
    for name, i in named.items():
        names[i] = name
    return pa.array(names, pa.string())


@lru_cache(maxsize=4)
def id_digits(path: str) -> pa.Array:
    """The decimal text of every id of a vocabulary."""
    return pa.array([str(i) for i in range(len(id_names(path)))], pa.string())


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, remembered: int = REMEMBERED_CHUNKS, most_bytes: int = REMEMBERED_BYTES):
        spec = _specification(path)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {content.encode(): i for content, i in special.items()}
        self._special_cut = regex.compile(b"(" + b"|".join(map(regex.escape, self.special)) + b")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._piece = regex.compile(pattern)
        self._space = regex.compile(r"\s+")
        self._cutter = Tokenizer.from_file(path)
        letters = byte_letters()
        self._byte = {c: b for b, c in enumerate(letters)}
        self._inner = [vocabulary.get(c) for c in letters]
        self._last = [vocabulary.get(c + self.end) for c in letters]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[(vocabulary[a], vocabulary[b])] = (rank, vocabulary[a + b])
        folds = any(n["type"] == "Lowercase" for n in spec["normalizer"]["normalizers"])
        self._known = Remembered(remembered, SPECIAL_MARK if folds else None, most_bytes)
        self._known_pieces: dict[str, bytes] = {}
        self._most_piece_bytes, self._piece_bytes = min(most_bytes, MOST_PIECE_BYTES), 0

    def _pieces(self, chunk: bytes) -> list[str | int]:
        """The pieces of one chunk; a special token is its id."""
        if SPECIAL_MARK in chunk and self._special_cut:
            found: list[str | int] = []
            for part in self._special_cut.split(chunk):
                found += [self.special[part]] if part in self.special else self._plain_pieces(part)
            return found
        return self._plain_pieces(chunk)

    def _plain_pieces(self, chunk: bytes) -> list[str]:
        text = chunk.decode()
        if text.isascii():
            text = text.lower()
        elif max(text) >= FIRST_UNSURE:
            pieces = self._cutter.pre_tokenizer.pre_tokenize_str(self._cutter.normalizer.normalize_str(text))
            return [bytes(map(self._byte.__getitem__, piece)).decode() for piece, _ in pieces]
        else:
            text = unicodedata.normalize("NFC", text)
            # The form of a letter does not depend on its place in the word, as that of sigma does in `lower`.
            text = text.lower() if "\u03a3" not in text else "".join([c.lower() for c in text])
        letters = text.rstrip(SYMBOLS)
        if letters.isalpha():
            # The commonest chunks: letters, and symbols after them.
            return [letters] if len(letters) == len(text) else [letters, text[len(letters):]]
        return self._piece.findall(self._space.sub(" ", text))

    def _symbols(self, piece: str) -> list[int]:
        """Symbols of a piece before any merge."""
        data = piece.encode()
        inner = self._inner
        found = [inner[b] for b in data[:-1]]
        found.append(self._last[data[-1]])
        return [s for s in found if s is not None] if None in found else found

    def _merge(self, pieces: list[list[int]]) -> list[list[int]]:
        """Apply all merges to all pieces at once, by an index from rank to the positions of its pair."""
        symbols: list[int] = []
        for piece in pieces:
            symbols += piece
            symbols.append(-1)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        before.append(n - 1)
        merges = self.merges
        positions: dict[tuple[int, int], list[int]] = defaultdict(list)
        for at, pair in enumerate(zip(symbols, symbols[1:])):
            if pair in merges:
                positions[pair].append(at)
        symbols.append(-1)
        active = [(*merges[pair], pair) for pair in positions]
        heapq.heapify(active)
        while active:
            _, merged, pair = heapq.heappop(active)
            left, right = pair
            for at in sorted(positions.pop(pair)):
                # An earlier merge may have taken either symbol of a listed pair.
                follower = after[at]
                if symbols[at] != left or symbols[follower] != right:
                    continue
                symbols[at] = merged
                symbols[follower] = -2
                after[at] = beyond = after[follower]
                before[beyond] = at
                ahead = before[at]
                for start, created in ((ahead, (symbols[ahead], merged)), (at, (merged, symbols[beyond]))):
                    if created in merges:
                        if created not in positions:
                            heapq.heappush(active, (*merges[created], created))
                        positions[created].append(start)
        symbols.pop()
        done: list[list[int]] = []
        current: list[int] = []
        for symbol in symbols:
            if symbol >= 0:
                current.append(symbol)
            elif symbol == -1:
                done.append(current)
                current = []
        return done

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        return self._merge([self._symbols(p) for p in pieces])

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Encode chunks that are not remembered."""
        known = self._known_pieces
        found = []
        for start in range(0, len(chunks), CHUNKS_AT_ONCE):
            cut = [self._pieces(c) for c in chunks[start:start + CHUNKS_AT_ONCE]]
            if self._piece_bytes > self._most_piece_bytes:
                known.clear()
                self._piece_bytes = 0
            missing = list({p for pieces in cut for p in pieces if type(p) is str and p not in known})
            for piece, ids in zip(missing, self._piece_ids(missing)):
                known[piece] = array("i", ids).tobytes()
                self._piece_bytes += len(piece) + 4 * len(ids) + ENTRY_BYTES
            found += [known[pieces[0]] if len(pieces) == 1 and type(pieces[0]) is str else
                      b"".join([known[p] if type(p) is str else array("i", [p]).tobytes() for p in pieces])
                      for pieces in cut]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        return self._known.encode(texts, self._learn)

    def forget(self) -> None:
        """Drop the remembered chunks and pieces; the vocabulary stays."""
        self._known.forget()
        self._known_pieces.clear()
        self._piece_bytes = 0


@lru_cache(maxsize=4)
def encoder(path: str) -> WordBpe:
    """One encoder per worker and vocabulary."""
    return WordBpe(path)


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    """Lists of ids without a Python object per id."""
    ends = np.cumsum([0] + [len(e) // 4 for e in encoded], dtype=np.int64).astype(np.int32)
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""
    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = id_lists(encoder(path).encode(texts(batch)))
        return pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), ids], names=schema.names)

    return map_texts(docs.select("doc_id", "text"), run, schema)


def spelt(ids: pa.ListArray, words: pa.Array) -> pa.Array:
    """The words of the ids of each list, with a space between two; the empty text for a null list."""
    # Offsets count from the first value of the slice's own buffer.
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(ends, words.take(ids.flatten())), " ")


def with_decoded(encoded: DataFrame, path: str) -> DataFrame:
    """Add `decoded`: the names of the ids, special ones too, with a space between two."""
    schema = T.StructType([f for f in encoded.schema.fields if f.name != "decoded"]
                          + [T.StructField("decoded", T.StringType())])

    def run(batches):
        names = id_names(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns = [column_of(part, f.name) for f in schema.fields[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, spelt(column_of(part, "ids"), names)], names=schema.names)

    return encoded.drop("decoded").mapInArrow(run, schema)


def _sha256(some: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(text.as_buffer() if text.is_valid else b"").hexdigest() for text in some], pa.string())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row.

    Texts are encoded, decoded and hashed in one worker: neither ids nor decoded texts leave it."""
    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = id_lists(encoder(path).encode(texts(batch)))
        return pa.RecordBatch.from_arrays(
            [column_of(batch, "doc_id"), pc.list_value_length(ids).cast(pa.int64()),
             _sha256(spelt(ids, id_digits(path))), _sha256(spelt(ids, id_names(path)))], names=schema.names)

    return map_texts(docs.select("doc_id", "text"), run, schema)
