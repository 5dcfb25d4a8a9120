"""Best-fit packing of tokenised documents by linear grouping.

A text's ids end with one end id; ids beyond the capacity start a new piece. Only the number of pieces of each
length (at most `capacity` numbers) goes to the driver, which plans the sequences: large lengths are sorted,
cut into groups of equal cardinality and rounded up to their group's largest; configurations of these few
sizes are optimised by column generation over a knapsack and rounded to whole sequences; the actual lengths
take the places of the rounded ones; the small lengths then go, longest first, into the tightest room. The
plan is a list of runs: so many sequences alike, each slot a range of the pieces of one length. Its size
depends on the capacity alone. Pieces are numbered within their length, and look up their run.

Results for odd input: a null or empty text is one piece that holds the end id alone; a null id is carried; repeated
rows are packed each; an empty table gives no piece; other columns are ignored. Ties between pieces of one
length are broken by their place in the input.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larder.llm.bpe import WordBpe, byte_letters
from larder.llm.common import column_of, text_slices, texts
from larder.sources.tables import staged

CAPACITY = 2048
END_ID = 0
# Lengths up to capacity / SMALL_PARTS are small: they fill what the configurations leave.
SMALL_PARTS = 3
# Groups of equal cardinality among the large lengths.
GROUPS = 300
MAX_PIVOTS = 2000
# Young chunks whose ids a worker remembers while it packs.
REMEMBERED_CHUNKS = 700_000
REMEMBERED_BYTES = 160 << 20


class LibraryIds(WordBpe):
    """Ids by the public library's model, which sees each distinct piece once."""

    def __init__(self, path: str):
        super().__init__(path, REMEMBERED_CHUNKS, REMEMBERED_BYTES)
        self._letters = dict(enumerate(byte_letters()))

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        tokenize, letters = self._cutter.model.tokenize, self._letters
        spelt = [p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters) for p in pieces]
        return [[token.id for token in tokenize(p)] for p in spelt]


@lru_cache(maxsize=4)
def library_ids(path: str) -> LibraryIds:
    """One per worker and vocabulary; what it remembers goes when other work begins."""
    return LibraryIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and (part, nth): the nth of its length in
    the input partition. Written once, so that these numbers stay."""
    schema = T.StructType([
        docs.select("doc_id").schema[0], T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_ids(path)
        met: dict[int, int] = defaultdict(int)
        end = END_ID.to_bytes(4, "little")
        for batch in text_slices(batches, encoder=encoder):
            rows = []
            owners = []
            for at, encoded in enumerate(encoder.encode(texts(batch))):
                ids = encoded + end
                view = memoryview(ids)
                for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = view[start:start + 4 * capacity]
                    length = len(cut) // 4
                    rows.append((number, start // 4, length, zlib.crc32(cut), met[length]))
                    owners.append(at)
                    met[length] += 1
            number, start, length, crc, nth = zip(*rows)
            take = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "doc_id").take(take), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), column_of(batch, "part").take(take),
                pa.array(nth, pa.int64())], names=schema.names)

    placed = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return staged(placed.mapInArrow(run, schema), "pieces")


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int,
                       limits: np.ndarray | None = None) -> np.ndarray:
    """How many of each size fill the capacity with the largest value; `limits` bounds the counts."""
    best = np.zeros(capacity + 1)
    choices = []
    for at, (size, value) in enumerate(zip(sizes, values)):
        most = capacity // size if limits is None else min(capacity // size, int(limits[at]))
        taken = np.zeros(capacity + 1, np.int64)
        new = best.copy()
        for count in range(1, most + 1):
            with_it = np.full(capacity + 1, -1.0)
            with_it[count * size:] = best[:capacity + 1 - count * size] + count * value
            better = with_it > new + 1e-12
            new[better] = with_it[better]
            taken[better] = count
        best = new
        choices.append(taken)
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for at in range(len(sizes) - 1, -1, -1):
        counts[at] = choices[at][room]
        room -= counts[at] * sizes[at]
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used, so that every size meets its demand at least and no size
    more than it: column generation for the relaxed problem, whole parts of it, then the fullest configuration
    of what is left, again and again."""
    basis = np.diag(capacity // sizes)
    inverse = np.diag(1 / np.diag(basis))
    # Products by rows, not by a linear algebra library, whose threads would fight over a busy driver's cores.
    times_inverse = lambda vector: (inverse * vector).sum(axis=1)
    for _ in range(MAX_PIVOTS):
        prices = inverse.sum(axis=0)
        column = best_configuration(sizes, prices, capacity)
        if (column * prices).sum() <= 1 + 1e-7:
            break
        direction = times_inverse(column)
        level = times_inverse(demand)
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(np.argmin(ratio))
        basis[:, leaves] = column
        row = inverse[leaves] / direction[leaves]
        inverse -= direction[:, None] * row
        inverse[leaves] = row
    level = np.maximum(times_inverse(demand), 0)
    left = demand.astype(np.int64).copy()
    used = []
    for at in np.argsort(-level):
        pattern = basis[:, at].astype(np.int64)
        times = int(min(np.floor(level[at] + 1e-9), (left[pattern > 0] // pattern[pattern > 0]).min()))
        if times > 0:
            used.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern = best_configuration(sizes, sizes.astype(float), capacity, left)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        used.append((pattern, times))
        left -= times * pattern
    return used


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs of sequences alike: (how many, [(length, first number within the length) of every slot]).

    `lengths` has the number of pieces of each length. Slot i of the j-th sequence of a run holds the piece
    with number first + j of its length."""
    small_limit = capacity // SMALL_PARTS
    large = [(s, lengths[s]) for s in sorted(lengths, reverse=True) if s > small_limit and lengths[s]]
    given: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, list[tuple[int, int]]]] = []
    total = sum(n for _, n in large)
    # Groups of equal cardinality, each a list of (length, pieces) from the longest on.
    each = max(1, -(-total // GROUPS))
    groups: list[list[list[int]]] = []
    room = 0
    for size, count in large:
        while count:
            if not room:
                groups.append([])
                room = each
            part = min(count, room)
            groups[-1].append([size, part])
            count, room = count - part, room - part
    rounded = [g[0][0] for g in groups]
    # Groups with the same largest length are one size.
    merged: dict[int, list[list[int]]] = {}
    for size, group in zip(rounded, groups):
        merged.setdefault(size, []).extend(group)
    sizes = np.array(list(merged), np.int64)
    queues = list(merged.values())
    if len(sizes):
        demand = np.array([sum(n for _, n in q) for q in queues], np.int64)
        for pattern, times in configurations(sizes, demand, capacity):
            # Substitution: the next actual pieces of each group, in stretches over which all lengths stay.
            while times:
                stretch, slots = times, []
                for group, count in enumerate(pattern):
                    if count:
                        head = queues[group][0]
                        if head[1] >= count:
                            stretch = min(stretch, head[1] // count)
                        else:
                            stretch = 1
                for group, count in enumerate(pattern):
                    need = int(count)
                    while need:
                        head = queues[group][0]
                        one = min(need, head[1] // stretch)
                        for _ in range(one):
                            slots.append((head[0], given[head[0]]))
                            given[head[0]] += stretch
                        head[1] -= one * stretch
                        need -= one
                        if not head[1]:
                            queues[group].pop(0)
                runs.append((stretch, slots))
                times -= stretch
    # Best fit of the small lengths, by room left: runs with the same room are filled one after the other.
    by_room: dict[int, list[int]] = defaultdict(list)
    for at, (_, slots) in enumerate(runs):
        by_room[capacity - sum(s for s, _ in slots)].append(at)
    for size in sorted((s for s in lengths if s <= small_limit), reverse=True):
        count = lengths[size]
        while count:
            fitting = [r for r, some in by_room.items() if r >= size and some]
            if not fitting:
                per = capacity // size
                times, fill = (count // per, per) if count >= per else (1, count)
                runs.append((times, []))
                by_room[capacity].append(len(runs) - 1)
                continue
            room = min(fitting)
            at = by_room[room].pop()
            times, slots = runs[at]
            fill = min(room // size, count)
            some = min(times, count // fill)
            if some < times:
                # The rest of the run keeps its room; its slots start `some` pieces later.
                runs.append((times - some, [(s, first + some) for s, first in slots]))
                by_room[room].append(len(runs) - 1)
            more = []
            for _ in range(fill):
                more.append((size, given[size]))
                given[size] += some
            runs[at] = (some, [*slots, *more])
            count -= some * fill
            by_room[room - fill * size].append(at)
    return runs


def _lookup(runs: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, sequence of it, offset) sorted by first number."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for times, slots in runs:
        offset = 0
        for size, first in slots:
            found[size].append((first, sequence, offset))
            offset += size
        sequence += times
    return {size: np.array(sorted(rows), np.int64) for size, rows in found.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = pieces(docs, path, capacity)
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows.
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_lookup(plan(lengths, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = cut.join(starts, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([*cut.select(*kept).schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = column_of(batch, "length").to_numpy()
            number = column_of(batch, "number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                mine = length == size
                rows = places.value[int(size)]
                at = np.searchsorted(rows[:, 0], number[mine], side="right") - 1
                sequence[mine] = rows[at, 1] + number[mine] - rows[at, 0]
                offset[mine] = rows[at, 2]
            yield pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in kept), pa.array(sequence),
                                              pa.array(offset)], names=schema.names)

    return numbered.select(*kept, "number").mapInArrow(run, schema)
