"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Words between ASCII white space, with A-Z in lower case, and one end per text are the tokens. All training
tokens are counted. The commonest words (and the end) are units in UNIT_CLASSES classes by rank; every other
word, known or not, belongs to a class by its shape. The class of the next token depends on hashed features of
its context (the word before, the one before that, both together, and a skip to the third); a unit within its
class depends on hashed words before too; a word within a shape class has its smoothed share of that class's
tokens. So the probabilities of all words, with one unseen word to a class, add up to one.

Training goes over all training documents, in ROUNDS shares: each task starts from the broadcast weights, makes
gradient steps over its documents in sparse numpy batches, and its weights are averaged by how often each
feature was met, FAN_IN tasks at a time. Model, words in the HEAD and their counts are bounded by parameters; the other
words' counts, which grow with the corpus, are joined.

Results for odd input: null and empty texts are one end token; a null id is a training document (its fold is
null); repeated rows get equal scores; without training tokens N is 0 and base_score is 0; an empty
table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, fold_of, map_texts, text_slices
from larder.sources.tables import staged

# The end of a text; no word is empty.
END = b""
HEAD = 100_000
UNIT_CLASSES = 20
UNITS = 48
SHAPE_CLASSES = 12
CLASSES = UNIT_CLASSES + SHAPE_CLASSES
# Buckets of each class feature and of each unit feature: powers of two.
BUCKETS = 1 << 13
UNIT_BUCKETS = 1 << 9
CLASS_FEATURES = 4
UNIT_FEATURES = 2
BLOCKS = 64
ROUNDS = 2
FAN_IN = 32
RATE = 0.3
STEP_TOKENS = 16_384
# Rows of weights changed at once: their numbers stay in a core's cache.
STEP_ROWS = 512
# The largest weight, either way, of which CLASS_FEATURES and a bias (up to some 25 either way) are added up in an exponent
# of e: floats of four bytes reach from e^-87 to e^88.
LARGEST_WEIGHT = 15
# Tokens whose logits stay there.
CACHED_TOKENS = 2048
LEVELS = 64
COUNTED_AT_ONCE = 200_000
LN10 = math.log(10)


def split(some: pa.StringArray) -> pa.ListArray:
    """The words of each text, in lower case; a null or blank text has no list."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(some))
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), None, trimmed))


def places_of(words: pa.BinaryArray) -> tuple[np.ndarray, pa.Buffer]:
    """Where each of at least one word begins in the buffer of them all, and where the last ends."""
    _, places, data = words.buffers()
    return np.frombuffer(places, np.int32)[words.offset:words.offset + len(words) + 1], data


def byte_strings(words: pa.BinaryArray) -> list[bytes]:
    """The words as Python's, several times faster than one by one through Arrow."""
    if not len(words):
        return []
    places, data = places_of(words)
    text = data.to_pybytes()
    return [text[a:b] for a, b in pairwise(places.tolist())]


def shape_class(word: bytes) -> int:
    """Class, from 0, of a word by its last character, its script and its length."""
    last = word[-1:]
    ending = 0 if last.isalnum() or last >= b"\x80" else 1 if last == b"." else 2 if last in b",;:" else 3 if last in b"!?)\"'" else 4
    foreign = not word.isascii()
    return 2 * ending + foreign + (10 if ending == 0 and len(word) > 7 else 0)


# What `shape_class` sees in a word's last byte.
ENDINGS = np.array([shape_class(b"a" + bytes([b])) // 2 for b in range(256)])


def shape_classes(words: pa.BinaryArray) -> np.ndarray:
    """`shape_class` of each of the words, none of which is empty."""
    if not len(words):
        return np.empty(0, np.int64)
    places, data = places_of(words)
    data = np.frombuffer(data, np.uint8)[places[0]:places[-1]]
    starts, ends = places[:-1] - places[0], places[1:] - places[0]
    ending = ENDINGS[data[ends - 1]]
    foreign = np.maximum.reduceat(data, starts) >= 0x80
    return 2 * ending + foreign + np.where((ending == 0) & (ends - starts > 7), 10, 0)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) of all whole texts; the end of a text is the empty word."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])

    def flush(counts: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                           names=schema.names)
        counts.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in text_slices(batches):
            # A slice's distinct words are counted before they become Python's.
            found = split(column_of(batch, "text")).flatten().value_counts()
            words, times = found.field("values").cast(pa.binary()), found.field("counts")
            counts.update(dict(zip(byte_strings(words), times.to_numpy().tolist())))
            counts[END] += batch.num_rows
            if len(counts) > COUNTED_AT_ONCE:
                yield flush(counts)
        if counts:
            yield flush(counts)

    return docs.select("text").mapInArrow(run, schema).groupBy("word").agg(F.sum("c").alias("c"))


class Model:
    """Head words with their counts, class totals, and the weights of the features."""

    def __init__(self, head: list[tuple[bytes, int]], totals: np.ndarray, kinds: np.ndarray, n: int, v: int):
        words = [w for w, _ in head]
        # The end of a text is always a unit.
        if END in words:
            words.remove(END)
        self.words = [END, *words]
        counts = dict(head)
        self.counts = np.array([counts.get(w, 0) for w in self.words], float)
        self.n, self.v = n, v
        self.head = pa.array(self.words, pa.binary())
        units = np.zeros(UNIT_CLASSES * UNITS)
        units[:len(self.counts[:len(units)])] = self.counts[:len(units)]
        # Places beyond the vocabulary must not draw any probability.
        filled = np.arange(len(units)) < len(self.words)
        self.unit_bias = np.where(filled, np.log(units + 0.5), -1e9).reshape(UNIT_CLASSES, UNITS).astype(np.float32)
        mass = np.r_[np.where(filled, units, 0).reshape(UNIT_CLASSES, UNITS).sum(axis=1), totals] + 0.5
        has = np.r_[filled.reshape(UNIT_CLASSES, UNITS).any(axis=1), np.ones(SHAPE_CLASSES, bool)]
        self.class_bias = np.where(has, np.log(mass / mass.sum()), -1e9).astype(np.float32)
        # Of head words: class and hash.
        ranks = np.arange(len(self.words))
        shapes = np.fromiter(map(shape_class, self.words), np.int64, len(ranks)) + UNIT_CLASSES
        self.classes_of = np.where(ranks < UNIT_CLASSES * UNITS, ranks // UNITS, shapes)
        self.hashes = np.fromiter(map(zlib.crc32, self.words), np.uint64, len(ranks))
        self.log_shape_total = np.log(totals + 0.5 * (kinds + 1))
        self.weights = np.zeros(self.sizes()[-1], np.float32)
        self._raised: tuple[np.ndarray, np.ndarray | None] | None = None

    @staticmethod
    def sizes() -> np.ndarray:
        """Where class weights and unit weights begin and end in one flat array."""
        return np.cumsum([0, CLASS_FEATURES * BUCKETS * CLASSES, UNIT_FEATURES * UNIT_CLASSES * UNIT_BUCKETS * UNITS])

    def raised(self) -> np.ndarray | None:
        """e to the power of the weights; None where products of their rows might leave the range of a float."""
        if self._raised is None or self._raised[0] is not self.weights:
            within = np.abs(self.weights).max() <= LARGEST_WEIGHT
            self._raised = self.weights, np.exp(self.weights) if within else None
        return self._raised[1]

    def views(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class rows and the unit rows of a flat array."""
        _, middle, end = self.sizes()
        return flat[:middle].reshape(-1, CLASSES), flat[middle:end].reshape(-1, UNITS)


class Tokens:
    """Tokens of several texts one after the other, with what the model needs of each."""

    def __init__(self, model: Model, lists: pa.ListArray | list[list[bytes]]):
        if not isinstance(lists, pa.ListArray):
            lists = pa.array(lists, pa.list_(pa.binary()))
        lengths = pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64) + 1
        # Each distinct token is looked at once; the last code is the end's.
        coded = lists.flatten().dictionary_encode()
        kinds = coded.dictionary.cast(pa.binary())
        ranks = pc.index_in(kinds, value_set=model.head).fill_null(-1).to_numpy().astype(np.int64)
        # Words beyond the head.
        rare = ranks < 0
        rare_kinds = kinds.filter(pa.array(rare))
        self.rare_words = byte_strings(rare_kinds)
        # The end has the first rank.
        ranks, rare = np.r_[ranks, 0], np.r_[rare, False]
        codes = np.full(lengths.sum(), len(kinds))
        inside = np.ones(len(codes), bool)
        inside[np.cumsum(lengths) - 1] = False
        codes[inside] = coded.indices.to_numpy()
        classes, hashes = model.classes_of[ranks], model.hashes[ranks]
        self.rank = ranks[codes]
        self.rare_at = np.flatnonzero(self.rank < 0)
        self.rare_ids = (np.cumsum(rare) - 1)[codes[self.rare_at]]
        classes[rare] = shape_classes(rare_kinds) + UNIT_CLASSES
        hashes[rare] = np.fromiter(map(zlib.crc32, self.rare_words), np.uint64, len(self.rare_words))
        self.owner = np.repeat(np.arange(len(lists)), lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.unit = (self.rank >= 0) & (self.rank < UNIT_CLASSES * UNITS)
        self.classes, word = classes[codes], hashes[codes]

        def back(gap: int) -> np.ndarray:
            moved = np.full(len(word), 0x51ED27, np.uint64)
            moved[gap:] = np.where(place[gap:] >= gap, word[:-gap] if gap else word, np.uint64(0x51ED27))
            return moved

        def bucket(values: np.ndarray, salt: int, buckets: int) -> np.ndarray:
            mixed = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
            return ((mixed ^ (mixed >> np.uint64(29))) & np.uint64(buckets - 1)).astype(np.int64)

        one, two, three = back(1), back(2), back(3)
        both = one * np.uint64(0x100000001B3) ^ two
        self.features = [bucket(x, salt, BUCKETS) + salt * BUCKETS for salt, x in enumerate((one, two, both, three))]
        self.unit_features = [
            (salt * UNIT_CLASSES + np.minimum(self.classes, UNIT_CLASSES - 1)) * UNIT_BUCKETS + bucket(x, 7 + salt, UNIT_BUCKETS)
            for salt, x in enumerate((one, two))]


def _cached(n: int) -> Iterator[slice]:
    """Parts of `n` tokens, CACHED_TOKENS at a time."""
    return (slice(start, min(start + CACHED_TOKENS, n)) for start in range(0, n, CACHED_TOKENS))


def _logits(bias: np.ndarray, rows: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Less the largest of each row, so that none is above 0."""
    total = rows.take(features[0], axis=0)
    total += bias
    for feature in features[1:]:
        total += rows.take(feature, axis=0)
    total -= total.max(axis=1, keepdims=True)
    return total


def _errors(bias: np.ndarray, kinds: np.ndarray | None, rows: np.ndarray, features: list[np.ndarray],
            right: np.ndarray) -> np.ndarray:
    """Probability of each column, less one in the right one; `kinds` are the tokens' rows of the
    bias, which is one row without them."""
    errors = np.empty((len(right), rows.shape[1]))
    for part in _cached(len(right)):
        chances = _logits(bias if kinds is None else bias[kinds[part]], rows, [f[part] for f in features])
        np.exp(chances, out=chances)
        chances /= chances.sum(axis=1, keepdims=True)
        errors[part] = chances
    errors[np.arange(len(right)), right] -= 1
    return errors


def _log_chances(bias: np.ndarray, kinds: np.ndarray | None, rows: np.ndarray, features: list[np.ndarray], right: np.ndarray,
                 raised: bool) -> np.ndarray:
    """Natural logarithm of the right column's probability. Where bias and rows are `raised`, products of powers of e take
    the place of sums, and no exponential is left to compute."""
    chances = np.empty(len(right), rows.dtype)
    for part in _cached(len(right)):
        some, at = [f[part] for f in features], right[part]
        row = np.arange(len(at))
        if raised:
            odds = rows.take(some[0], axis=0)
            odds *= bias if kinds is None else bias[kinds[part]]
            for feature in some[1:]:
                odds *= rows.take(feature, axis=0)
            chances[part] = np.log(odds[row, at]) - np.log(np.einsum("ij->i", odds))
        else:
            logits = _logits(bias if kinds is None else bias[kinds[part]], rows, some)
            chances[part] = logits[row, at] - np.log(np.exp(logits).sum(axis=1))
    return chances


def _sums(numbers: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """The rows of `weights` (floats of eight bytes) added up by their numbers below `n`, in one pass over all columns."""
    # Two columns at once, as the parts of complex numbers.
    values = weights.view(np.complex128) if weights.shape[1] % 2 == 0 else weights
    columns = values.shape[1]
    sums = np.zeros(n * columns, values.dtype)
    for part in _cached(len(numbers)):
        cells = (numbers[part] * columns)[:, None] + np.arange(columns)
        np.add.at(sums, cells.ravel(), values[part].ravel())
    return sums.view(np.float64).reshape(n, -1)


def _step(rows: np.ndarray, squares: np.ndarray, met: np.ndarray, features: list[np.ndarray], error: np.ndarray) -> None:
    """One Adagrad step for the rows of each feature, which lie in a range of their own."""
    error = error.astype(np.float64, copy=False)
    for feature in features:
        low = int(feature.min())
        place = feature - low
        times = np.bincount(place)
        which = np.flatnonzero(times)
        gradient = _sums((np.cumsum(times > 0) - 1)[place], len(which), error)
        # Between sum and mean over the tokens that met the feature, so that common ones do not jump.
        gradient = (gradient / np.sqrt(times[which])[:, None]).astype(np.float32)
        met[which + low] += times[which]
        for start in range(0, len(which), STEP_ROWS):
            at, some = which[start:start + STEP_ROWS] + low, gradient[start:start + STEP_ROWS]
            square = squares.take(at, axis=0)
            square += some * some
            squares[at] = square
            square += 1
            some *= RATE
            some /= np.sqrt(square, out=square)
            rows[at] = rows.take(at, axis=0) - some


def train_on(model: Model, flat: np.ndarray, squares: np.ndarray, met: tuple[np.ndarray, np.ndarray], tokens: Tokens) -> None:
    """Gradient steps on the weights `flat`, in batches of STEP_TOKENS."""
    rows, unit_rows = model.views(flat)
    row_squares, unit_squares = model.views(squares)
    for start in range(0, len(tokens.rank), STEP_TOKENS):
        part = slice(start, start + STEP_TOKENS)
        features = [f[part] for f in tokens.features]
        error = _errors(model.class_bias, None, rows, features, tokens.classes[part])
        _step(rows, row_squares, met[0], features, error)
        at = start + np.flatnonzero(tokens.unit[part])
        if len(at):
            features = [f[at] for f in tokens.unit_features]
            error = _errors(model.unit_bias, tokens.classes[at], unit_rows, features, tokens.rank[at] % UNITS)
            _step(unit_rows, unit_squares, met[1], features, error)


def log_probabilities(model: Model, tokens: Tokens) -> np.ndarray:
    """Natural logarithm of each token's probability; for words of shape classes without their own count."""
    powers = model.raised()
    raised = powers is not None
    rows, unit_rows = model.views(powers if raised else model.weights)
    bias, unit_bias = (np.exp(b) if raised else b for b in (model.class_bias, model.unit_bias))
    found = _log_chances(bias, None, rows, tokens.features, tokens.classes, raised).astype(np.float64)
    at = np.flatnonzero(tokens.unit)
    found[at] += _log_chances(unit_bias, tokens.classes[at], unit_rows, [f[at] for f in tokens.unit_features],
                              tokens.rank[at] % UNITS, raised)
    other = ~tokens.unit
    found[other] -= model.log_shape_total[tokens.classes[other] - UNIT_CLASSES]
    return found


def _merged(parts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums over several tasks' blocks: the weights, each times how often its feature was met, and these times."""
    sums = sum(np.frombuffer(b, np.float32) for b in parts["sums"])
    met = sum(np.frombuffer(b, np.float32) for b in parts["met"])
    return sums, met


def train_round(docs: DataFrame, model: Model) -> np.ndarray:
    """The model's weights after all tasks have trained on their documents, averaged."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("task", T.LongType()), T.StructField("block", T.IntegerType()),
                           T.StructField("sums", T.BinaryType()), T.StructField("met", T.BinaryType())])
    sizes = Model.sizes()
    widths = np.r_[np.full(sizes[1] // CLASSES, CLASSES), np.full((sizes[2] - sizes[1]) // UNITS, UNITS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        flat, squares = base.weights.copy(), np.zeros_like(base.weights)
        met = (np.zeros(sizes[1] // CLASSES), np.zeros((sizes[2] - sizes[1]) // UNITS))
        task = None
        for batch in text_slices(batches):
            task = column_of(batch, "task")[0].as_py()
            train_on(base, flat, squares, met, Tokens(base, split(column_of(batch, "text"))))
        if task is None:
            return
        times = np.concatenate(met).astype(np.float32)
        sums = flat * np.repeat(times, widths)
        for block, (a, b) in enumerate(zip(np.array_split(sums, BLOCKS), np.array_split(times, BLOCKS))):
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([block], pa.int32()),
                                              pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())],
                                             names=schema.names)

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        sums, met = _merged(parts)
        return pd.DataFrame({"task": [parts["task"].iloc[0] // FAN_IN], "block": [parts["block"].iloc[0]],
                             "sums": [sums.tobytes()], "met": [met.tobytes()]})

    parts = docs.select("text", F.spark_partition_id().cast("long").alias("task")).mapInArrow(run, schema)
    tasks = docs.rdd.getNumPartitions()
    while tasks > 1:
        parts = parts.groupBy("block", F.floor(F.col("task") / FAN_IN)).applyInPandas(merge, schema)
        tasks = -(-tasks // FAN_IN)
    # BLOCKS rows of fixed size.
    merged = parts.toPandas().sort_values("block")
    if not len(merged):
        return model.weights
    sums = np.concatenate([np.frombuffer(b, np.float32) for b in merged["sums"]])
    met = np.repeat(np.concatenate([np.frombuffer(b, np.float32) for b in merged["met"]]), widths)
    return np.where(met > 0, sums / np.maximum(met, 1), model.weights).astype(np.float32)


def train(docs: DataFrame, counts: DataFrame) -> Model:
    """A model of the training documents, whose counted words are given."""
    # Words by their count's logarithm, in bins: the commonest bins with HEAD words at most.
    level = F.floor(F.log2("c") * LEVELS)
    floor, held = math.inf, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        held += r["count"]
        if held > HEAD:
            break
        floor = r["level"]
    chosen = counts.filter(level >= floor).collect() if floor < math.inf else []
    head = sorted(((bytes(r["word"]), r["c"]) for r in chosen), key=lambda h: (-h[1], h[0]))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    units = {w for w, _ in [(END, 0), *[h for h in head if h[0] != END]][:UNIT_CLASSES * UNITS]}
    schema = T.StructType([T.StructField("shape", T.IntegerType()), T.StructField("c", T.LongType()), T.StructField("kinds", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(SHAPE_CLASSES, np.int64), np.zeros(SHAPE_CLASSES, np.int64)
        for batch in batches:
            for word, c in zip(column_of(batch, "word").to_pylist(), column_of(batch, "c").to_pylist()):
                if word not in units:
                    shape = shape_class(word)
                    total[shape] += c
                    kinds[shape] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(SHAPE_CLASSES), pa.int32()), pa.array(total), pa.array(kinds)], names=schema.names)

    totals, kinds = np.zeros(SHAPE_CLASSES), np.zeros(SHAPE_CLASSES)
    shapes = counts.select("word", "c").mapInArrow(run, schema).groupBy("shape").agg(F.sum("c").alias("c"), F.sum("kinds").alias("kinds"))
    for r in shapes.collect():
        totals[r["shape"]], kinds[r["shape"]] = r["c"], r["kinds"]
    model = Model(head, totals, kinds, n, v)
    for turn in range(ROUNDS):
        share = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == turn)
        model.weights = train_round(share, model)
    return model


def score(docs: DataFrame, model: Model, counts: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", held_out.alias("held_out"), "text")
    tail = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))
    schema = T.StructType([*rows.drop("text").schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
                           T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType()), T.StructField("tail", tail)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        tokens = Tokens(model, split(column_of(batch, "text")))
        n = batch.num_rows
        in_head = tokens.rank >= 0
        own = np.where(in_head, np.log10(model.counts[np.maximum(tokens.rank, 0)] + 0.5), 0)
        known = in_head & (model.counts[np.maximum(tokens.rank, 0)] > 0)
        chance = log_probabilities(model, tokens) / LN10 + np.where(tokens.unit, 0, own)
        sums = [np.bincount(tokens.owner, weights=w, minlength=n) for w in (known, own, chance)]
        kinds = max(1, len(tokens.rare_words))
        pair, times = np.unique(tokens.owner[tokens.rare_at] * kinds + tokens.rare_ids, return_counts=True)
        ends = pa.array(np.r_[0, np.cumsum(np.bincount(pair // kinds, minlength=n))].astype(np.int32))
        words = pa.array(tokens.rare_words, pa.binary()).take(pa.array(pair % kinds))
        pairs = pa.StructArray.from_arrays([words, pa.array(times)], names=["word", "times"])
        return pa.RecordBatch.from_arrays(
            [column_of(batch, c) for c in ("key", "doc_id", "held_out")]
            + [pa.array(np.bincount(tokens.owner, minlength=n)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]),
               pa.array(sums[2]), pa.ListArray.from_arrays(ends, pairs)], names=schema.names)

    found = staged(map_texts(rows, run, schema), "scored")
    rare = found.select("key", F.explode("tail").alias("pair")).select("key", "pair.word", "pair.times")
    c = F.coalesce("c", F.lit(0))
    sums = rare.join(counts, "word", "left").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    per_token = math.log10(model.n + 0.5 * (model.v + 1))
    return found.drop("tail").join(sums, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * per_token).alias("base_score"), (F.col("model") + more).alias("score"))


def train_and_score(docs: DataFrame, folds: int = 5, held_out: int = 1) -> DataFrame:
    """Scores of all rows by a model that learns from the rows outside the held-out fold."""
    fold = F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False))
    training = docs.filter(~fold).select("doc_id", "text")
    counts = staged(count_words(training), "word_counts")
    return score(docs, train(training, counts), counts, fold)
