"""Hard negatives of anchor vectors: rows of another label whose score comes close to a positive's, from below.

A score is the integer inner product of two vectors, each component x taken as floor(scale * x). An anchor's positives
are the best rows of its own label; a negative fits a positive if it lies between `lower` hundredths of the positive's
score and that score. The windows of an anchor's positives overlap. Their upper limits, which are the positives' scores,
cut the scores into disjoint slots: a task keeps the best few rows per anchor and slot, tasks are merged per slot, and
the rows below one positive's limit are the slots from its own downwards, in order: the first few of them that reach
the window's lower end are the answer.

All rows are scored against all anchors, in blocks: the anchors of one block, at most ANCHOR_BYTES of vectors, are
sent to the executors, and each block takes two passes over the rows (positives, then negatives), which are never
shuffled. A task sends on at most `positives` rows per anchor in the first pass, and `positives * negatives` in the
second.

Results for odd input: rows with a null id, label or vector, or with a null or non-finite component, take no part;
an empty vector scores 0; of vectors of different lengths the missing components count as 0; a repeated row is a row
of its own, but no other row to an anchor of its id, and repeated anchors answer once; equal scores go by smaller id;
scores beyond 2**55 count as 2**55. An empty table, or one without anchors, has an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of
from larder.sources.tables import staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOWER = 80
# Vectors of one block of anchors, which the driver and every worker hold.
ANCHOR_BYTES = 16 << 20
# Scores held at once in a task.
SCORES_AT_ONCE = 1 << 20
# Room for a score times a hundred.
MOST = 2**55
NONE = -(2**62)


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of the lists' components as floating numbers, short ones filled with 0, and which rows are whole."""
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy()
    width = int(lengths.max(initial=0))
    if len(values) == width * len(lengths):
        matrix = values.reshape(len(lengths), width)
    else:
        matrix = np.zeros((len(lengths), width))
        row = np.repeat(np.arange(len(lengths)), lengths)
        matrix[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return matrix, usable & np.isfinite(matrix).all(axis=1)


def quantised(matrix: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite numbers, as floating numbers without fractions."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * matrix))


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers, one line per row; beyond 2**55 they count as 2**55."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    with np.errstate(over="ignore"):
        size = np.linalg.norm(rows, axis=1) * np.linalg.norm(anchors, axis=1).max(initial=0)
    # No partial sum is greater than the product of the norms: below these limits floating sums are exact.
    if size.max(initial=0) < 2**24:
        return (rows.astype(np.float32) @ anchors.T.astype(np.float32)).astype(np.int64)
    done = np.empty((len(rows), len(anchors)), np.int64)
    exact = size < 2**53
    done[exact] = (rows[exact] @ anchors.T).astype(np.int64)
    if not exact.all():
        whole = [[int(x) for x in line] for line in anchors]
        for at in np.flatnonzero(~exact):
            line = [int(x) for x in rows[at]]
            done[at] = [max(-MOST, min(MOST, sum(x * y for x, y in zip(line, other)))) for other in whole]
    return done


def best(group: np.ndarray, score: np.ndarray, row: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The first `keep` of every group by falling score, then rising id; sorted so."""
    order = np.lexsort((row, -score, group))
    group, score, row = group[order], score[order], row[order]
    place = np.arange(len(group))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), place, 0)) \
        if len(group) else place
    kept = place - first < keep
    return group[kept], score[kept], row[kept]


class Keeper:
    """The best rows of every group met so far, and the score that a further row must reach."""

    def __init__(self, groups: int, keep: int):
        self.keep = keep
        self.least = np.full(groups, NONE)
        self.held = (np.zeros(0, np.int64),) * 3

    def add(self, group: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        near = score >= self.least[group]
        if near.any():
            more = (group[near], score[near], row[near])
            self.held = best(*[np.concatenate(pair) for pair in zip(self.held, more)], self.keep)
            last = np.flatnonzero(np.bincount(self.held[0], minlength=len(self.least)) == self.keep)
            ends = np.searchsorted(self.held[0], last, "right") - 1
            self.least[last] = self.held[1][ends]


# Rows of a batch and the scores of some of them: labels, ids, scores to every anchor.
Chosen = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _scan(batches: Iterator[pa.RecordBatch], anchors: np.ndarray, keeper: Keeper, chosen: Chosen, scale: int) -> None:
    """Offer every row of a task to the keeper."""
    step = max(1, SCORES_AT_ONCE // max(1, len(anchors)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            label, vec_id = column_of(part, "label"), column_of(part, "vec_id")
            known = pc.and_(label.is_valid(), vec_id.is_valid()).to_numpy(zero_copy_only=False)
            matrix, usable = vectors(column_of(part, "embedding"))
            usable &= known
            found = scores(quantised(matrix[usable], scale), anchors)
            keeper.add(*chosen(label.fill_null(0).to_numpy()[usable], vec_id.fill_null(0).to_numpy()[usable], found))


def _batch(names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _scanned(rows: DataFrame, run: Callable, names: list[str]) -> DataFrame:
    return rows.mapInArrow(run, T.StructType([T.StructField(name, T.LongType()) for name in names]))


def _first(df: DataFrame, keys: list[str], score: str, row: str, keep: int) -> DataFrame:
    """The best rows of each group over all tasks, with their place from 0."""
    by_score = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(row))
    return df.withColumn("_place", F.row_number().over(by_score) - 1).filter(F.col("_place") < keep)


def positives_of(rows: DataFrame, anchors: tuple[np.ndarray, ...], keep: int, scale: int) -> DataFrame:
    """anchor (its number), place from 0, positive_score and positive_id of the best rows of each anchor's label."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix = sent.value
        keeper = Keeper(len(ids), keep)

        def same_label(label: np.ndarray, vec_id: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, ...]:
            line, anchor = np.nonzero((label[:, None] == labels) & (vec_id[:, None] != ids) & (found >= keeper.least))
            return anchor, found[line, anchor], vec_id[line]

        _scan(batches, matrix, keeper, same_label, scale)
        yield from _batch(["anchor", "positive_score", "positive_id"], list(keeper.held))

    found = _scanned(rows, run, ["anchor", "positive_score", "positive_id"])
    return _first(found, ["anchor"], "positive_score", "positive_id", keep).withColumnRenamed("_place", "place")


def negatives_of(rows: DataFrame, anchors: tuple[np.ndarray, ...], limits: np.ndarray, keep: int, lower: int,
                 scale: int) -> DataFrame:
    """anchor and its `negatives`: the best rows of every slot, one slot after the other.

    `limits` holds each anchor's positive scores, falling; slot k lies above limit k + 1, up to limit k."""
    sent = rows.sparkSession.sparkContext.broadcast((*anchors, limits))
    slots = limits.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix, limits = sent.value
        keeper = Keeper(len(ids) * slots, keep)
        # Only limits from 0 on have a window; the lowest one reaches down furthest.
        floor = np.where(limits >= 0, -(-lower * limits // 100), MOST + 1).min(axis=1)

        def other_label(label: np.ndarray, vec_id: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, ...]:
            line, anchor = np.nonzero((label[:, None] != labels) & (found >= floor) & (found <= limits[:, 0]))
            score = found[line, anchor]
            slot = (limits[anchor] >= score[:, None]).sum(axis=1) - 1
            return anchor * slots + slot, score, vec_id[line]

        _scan(batches, matrix, keeper, other_label, scale)
        group, score, row = keeper.held
        yield from _batch(["anchor", "slot", "score", "vec_id"], [group // slots, group % slots, score, row])

    found = _scanned(rows, run, ["anchor", "slot", "score", "vec_id"]).repartition("anchor")
    kept = _first(found, ["anchor", "slot"], "score", "vec_id", keep)
    entry = F.struct(F.col("slot"), (-F.col("score")).alias("below"), F.col("vec_id"))
    return kept.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("negatives"))


def windows_answered(positives: DataFrame, negatives: DataFrame, keep: int, lower: int) -> DataFrame:
    """One row per anchor, positive and rank: of the slots from the positive's own downwards the first `keep` rows
    that lie in its window."""
    suffix = F.slice(F.filter("negatives", lambda n: n["slot"] >= F.col("place")), 1, keep)
    answer = F.filter(suffix, lambda n: lower * F.col("positive_score") <= -100 * n["below"])
    return (
        positives.join(negatives, "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(answer).alias("_rank", "_negative"))
        .select("anchor_id", "positive_id", (F.col("_rank") + 1).cast("int").alias("rank"),
                F.col("_negative.vec_id").alias("negative_id"), "positive_score",
                (-F.col("_negative.below")).alias("negative_score"))
    )


def anchor_blocks(anchors: DataFrame, scale: int, block_bytes: int) -> tuple[DataFrame, int]:
    """Usable anchors once each, with the number of their block, and the number of blocks.

    Blocks go by a hash of the row; their greatest size is checked, and their number doubled until it fits."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.LongType()),
                           T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, usable = vectors(column_of(batch, "embedding"))
            usable &= column_of(batch, "label").is_valid().to_numpy(zero_copy_only=False)
            lines = quantised(matrix[usable], scale)
            mask = pa.array(usable)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, name).filter(mask).cast(pa.int64()) for name in ("vec_id", "label")]
                + [pa.array(list(lines), pa.list_(pa.float64()))], names=schema.names)

    once = staged(anchors.mapInArrow(run, schema).distinct(), "anchors")
    rows, width = once.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    most = max(1, block_bytes // (8 * max(1, width)))
    blocks = -(-rows // most)
    while blocks:
        cut = once.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)))
        if blocks == 1 or cut.groupBy("block").count().agg(F.max("count")).first()[0] <= most:
            return cut, blocks
        blocks *= 2
    return once.withColumn("block", F.lit(0)), 0


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lower: int = LOWER, scale: int = SCALE, block_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    `rows` holds vec_id, label (integers) and embedding (array of numbers)."""
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    anchors, blocks = anchor_blocks(rows.filter(is_anchor & F.col("vec_id").isNotNull()), scale, block_bytes)
    answers = []
    for block in range(blocks):
        some = anchors.filter(F.col("block") == block).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        matrix, _ = vectors(some["vector"].combine_chunks())
        ids = some["vec_id"].to_numpy()
        packed = (ids, some["label"].to_numpy(), matrix)
        found = staged(positives_of(rows, packed, positives, scale), "positives")
        # At most `positives` numbers an anchor of the block.
        limits = np.full((len(ids), positives), NONE)
        scored = found.select("anchor", "place", "positive_score").toArrow()
        limits[scored["anchor"].to_numpy(), scored["place"].to_numpy()] = scored["positive_score"].to_numpy()
        names = rows.sparkSession.createDataFrame(
            pa.table({"anchor": np.arange(len(ids)), "anchor_id": ids}))
        nearest = negatives_of(rows, packed, limits, negatives, lower, scale)
        answers.append(staged(windows_answered(found.join(names, "anchor"), nearest, negatives, lower), "negatives"))
    if not answers:
        empty = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                 "negative_score long")
        return rows.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, answers)


def sql(positives: int = POSITIVES, negatives: int = NEGATIVES, lower: int = LOWER, scale: int = SCALE,
        every: int = 100) -> str:
    """The same in DuckDB SQL over `embeddings`, by all pairs, for anchors of ids divisible by `every`."""
    return f"""
    WITH usable AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
        list_inner_product(a.v, r.v)::BIGINT AS score
      FROM usable a JOIN usable r ON a.vec_id % {every} = 0 AND a.vec_id <> r.vec_id),
    positive AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
    SELECT p.anchor_id, p.positive_id,
      row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
      n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
      AND {lower} * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
    QUALIFY rank <= {negatives}
    """
