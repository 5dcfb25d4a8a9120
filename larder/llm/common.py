"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Documents handled at once inside a task: bounds the Python side whatever the Arrow batch holds.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20
# What a remembered chunk takes beside its own bytes: two objects and a place in the table.
ENTRY_BYTES = 170


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The encoder that remembers most, in whose tasks alone this worker's memory may hold its chunks.
_remembering: list["Remembering"] = []


class Remembering(Protocol):
    def forget(self) -> None:
        """Drop what was remembered; this only costs time."""


def remember_only(encoder: Remembering | None) -> None:
    """Let `encoder` remember from one task to the next, until a task of another operator begins in this worker."""
    for other in _remembering:
        if other is not encoder:
            other.forget()
    _remembering[:] = [] if encoder is None else [encoder]


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                encoder: Remembering | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds at most SLICE_ROWS rows and about SLICE_BYTES of `column`.

    A single longer text makes a slice of its own. A worker outlives a stage: what others than `encoder` remember would
    stand beside this task's memory."""
    remember_only(encoder)
    for batch in batches:
        lengths = batch.column(batch.schema.get_field_index(column)).fill_null("")
        sizes = pc.binary_length(lengths).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and (row - start >= SLICE_ROWS or held + size > SLICE_BYTES):
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values, null as the empty text."""
    return batch.column(batch.schema.get_field_index(column)).fill_null("").to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def map_texts(df: DataFrame, per_slice: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType,
              column: str = "text") -> DataFrame:
    """Apply a function of record batches to bounded slices of `df`, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, column):
            yield per_slice(part)

    return df.mapInArrow(run, schema)


def fold_of(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(folds)


class Remembered(dict):
    """Encoded chunks of text, of which a worker remembers the latest: `limit` young ones and as many older, and where
    `most_bytes` is given at most about so many bytes of each.

    Forgetting only costs time. Chunks are the runs between ASCII white space. `case_mark` is set for encodings
    that do not tell cases apart but for texts with that mark in them: others are put in lower case first."""

    def __init__(self, limit: int, case_mark: bytes | None = None, most_bytes: int | None = None):
        super().__init__()
        self.limit, self.case_mark, self.older, self.unknown = limit, case_mark, {}, set()
        self.most_bytes, self.held = most_bytes, 0

    def forget(self) -> None:
        """Drop all remembered chunks."""
        self.clear()
        self.older, self.held = {}, 0

    def _chunks(self, text: str) -> list[bytes]:
        data = text.encode()
        return data.split() if self.case_mark is None or self.case_mark in data else data.lower().split()

    def __missing__(self, chunk: bytes) -> bytes:
        value = self.older.get(chunk)
        if value is None:
            self.unknown.add(chunk)
            return b""
        self[chunk] = value
        return value

    def encode(self, some: list[str], learn: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """The encoded chunks of each text, joined; `learn` encodes chunks that are not remembered."""
        split = [self._chunks(text) for text in some]
        found = [list(map(self.__getitem__, chunks)) for chunks in split]
        if self.unknown:
            new = list(self.unknown)
            self.unknown = set()
            values = learn(new)
            more = sum(map(len, new)) + sum(map(len, values)) + ENTRY_BYTES * len(new)
            if len(self) + len(new) > self.limit or self.most_bytes and self.held + more > self.most_bytes:
                self.older = dict(self) if self.most_bytes is None or self.held <= self.most_bytes else {}
                self.clear()
                self.held = 0
            self.held += more
            self.update(zip(new, values))
            for chunks, values in zip(split, found):
                if not all(values):
                    for at, value in enumerate(values):
                        if not value:
                            values[at] = self[chunks[at]]
        return [b"".join(values) for values in found]
