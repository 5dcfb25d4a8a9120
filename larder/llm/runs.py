"""Periodic runs of words in whole texts, found on a grammar of the word ids.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), at least `shortest`
words and two periods long, that no neighbouring word extends. The texts of a slice are worked on together:

1. Words get ids. A run repeats each of its windows of six words one period on, so a word outside every window
   that its text holds twice is in no run: it gets an id of its own, which nothing can pair with.
2. Re-Pair in rounds: a round replaces every pair of neighbours that occurs at least twice and is commoner than
   the pairs it overlaps, until no pair occurs twice. What is left of a stretch is paired off evenly, so that one
   symbol derives it. Every pair replaced is a nonterminal, shared by all its places in all texts of the slice.
3. Every run lies across the boundary of the lowest nonterminal that derives all of it. For each nonterminal, once:
   a run of period q across boundary b makes word b - q equal to word b, or b - 1 to b - 1 + q; both candidates are
   stretched to both sides with the prefix sums of two modular hashes, and compared word by word at the end.
4. The runs are carried to all places where the nonterminal is derived; those that a neighbour extends belong to a
   nonterminal above and go, and of one interval the smallest period stays.

Results for odd input: null and empty texts have no words and no runs; a text of any length is taken whole (a task
holds one slice of texts, or one longer text); repeated rows each give a row; a null doc_id is an id like others;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.common import column_of, map_texts, texts

SHORTEST = 12
# Positions compared at once: bounds the working arrays, not the result.
BLOCK = 1 << 20
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 742_938_285)

Reword = Callable[[object, list[bytes]], list[bytes]]


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The agreed test change: in every tenth document by checksum, the words from one on repeat with a period."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    piece = words[start:start + period]
    return words[:start] + (piece * ((n - start) // period + 1))[:n - start]


def ragged(lengths: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Items first..last of all items of groups of the given lengths: the group of each, and its number there."""
    ends = np.cumsum(lengths)
    item = np.arange(first, last)
    group = np.searchsorted(ends, item, "right")
    return group, item - (ends[group] - lengths[group])


def blocks(lengths: np.ndarray):
    """All items of groups of the given lengths, at most BLOCK at once."""
    total = int(lengths.sum())
    for first in range(0, total, BLOCK):
        yield ragged(lengths, first, min(first + BLOCK, total))


class Collision(Exception):
    """Two different stretches with equal hashes."""


class Hashes:
    """Equal stretches of one array of ids, by two modular hashes of every prefix."""

    def __init__(self, ids: np.ndarray, attempt: int = 0):
        self.n, self.attempt = len(ids), attempt
        self._sums, self._powers = [], []
        for prime, base in zip(PRIMES, BASES):
            base = (base + 7919 * attempt) % prime
            powers = np.ones(1, np.int64)
            while len(powers) <= self.n:
                powers = np.concatenate((powers, powers * (powers[-1] * base % prime) % prime))
            powers = powers[:self.n + 1]
            sums = np.concatenate(([0], np.cumsum((ids + 1) % prime * powers[:-1] % prime))) % prime
            self._sums.append(sums)
            self._powers.append(powers)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at a < b of the given length have equal hashes."""
        equal = np.ones(len(a), bool)
        for prime, sums, powers in zip(PRIMES, self._sums, self._powers):
            left = (sums[a + length] - sums[a]) % prime
            right = (sums[b + length] - sums[b]) % prime
            equal &= left * powers[b - a] % prime == right
        return equal

    def stretch(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The greatest length, up to `most`, of equal stretches from (or, `back`, up to) a and b."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            shift = middle if back else 0
            equal = self.same(a[open_] - shift, b[open_] - shift, middle)
            low[open_[equal]] = middle[equal]
            high[open_[~equal]] = middle[~equal] - 1


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` ids from each place on; places without so many get ids of their own."""
    n = max(len(ids) - width + 1, 0)
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = (total ^ mixed[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return np.concatenate((total, np.arange(len(ids) - len(total), dtype=np.uint64)))


def mask_single(ids: np.ndarray, text_of: np.ndarray, width: int) -> np.ndarray:
    """Ids, where a word in no window that its text holds twice gets an id of its own."""
    n = len(ids) - width + 1
    in_run = np.zeros(len(ids) + 1, np.int64)
    if n > 0:
        keyed = windows(ids, width)[:n]
        order = np.argsort(keyed, kind="stable")
        keyed, owner = keyed[order], text_of[order]
        # A window may not reach into the next text: the words between texts have ids of their own.
        again = np.flatnonzero((keyed[1:] == keyed[:-1]) & (owner[1:] == owner[:-1]))
        starts = np.union1d(order[again], order[again + 1])
        in_run[starts] += 1
        np.subtract.at(in_run, starts + width, 1)
    alone = np.cumsum(in_run)[:-1] == 0
    masked = ids.copy()
    masked[alone] = ids.max(initial=0) + 1 + np.arange(alone.sum())
    return masked


@dataclass
class Grammar:
    """Nonterminals by number, and the symbols that derive the whole. Symbols below `terminals` are words."""

    terminals: int
    symbols: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    rules: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)


def _positions_to_replace(key: np.ndarray, free: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Starts of the pairs that a round replaces: commoner than the pairs they overlap, and at least twice so."""
    at = np.flatnonzero(free)
    if not len(at):
        return at
    pairs, which, times = np.unique(key[at], return_inverse=True, return_counts=True)
    derived = np.zeros(len(pairs), np.int64)
    derived[which] = length[at] + length[at + 1]
    # Commoner pairs first, then those that derive fewer words: equal pairs then halve a text instead of eating along it.
    order = np.lexsort((np.arange(len(pairs)), derived, -times))
    rank = np.empty(len(pairs), np.int64)
    rank[order] = np.arange(len(pairs))
    none = len(pairs)
    rank[times < 2] = none
    ranked = np.full(len(key) + 2, none)
    ranked[at + 1] = rank[which]
    here, before, after = ranked[1:-1], ranked[:-2], ranked[2:]
    best = (here < none) & (here <= before) & (here <= after)
    # In a row of equal overlapping pairs every second one, from the first on.
    starts = np.flatnonzero(best)
    if not len(starts):
        return starts
    follows = np.concatenate(([False], (starts[1:] == starts[:-1] + 1) & (here[starts[1:]] == here[starts[:-1]])))
    row = np.maximum.accumulate(np.where(follows, 0, np.arange(len(starts))))
    chosen = starts[(np.arange(len(starts)) - row) % 2 == 0]
    _, which, times = np.unique(key[chosen], return_inverse=True, return_counts=True)
    return chosen[times[which] > 1]


def _replaced(g: Grammar, chosen: np.ndarray, key: np.ndarray, next_symbol: int) -> int:
    """Put one new nonterminal for every pair at the chosen places; the next free symbol."""
    pairs, first, which = np.unique(key[chosen], return_index=True, return_inverse=True)
    g.rules.append((next_symbol, g.symbols[chosen[first]], g.symbols[chosen[first] + 1]))
    g.symbols[chosen] = next_symbol + which
    g.lengths[chosen] += g.lengths[chosen + 1]
    keep = np.ones(len(g.symbols), bool)
    keep[chosen + 1] = False
    g.symbols, g.places, g.lengths = g.symbols[keep], g.places[keep], g.lengths[keep]
    return next_symbol + len(pairs)


def grammar(ids: np.ndarray) -> Grammar:
    """Re-Pair over ids, and a single symbol for each stretch between words that occur once.

    Words that occur once are in no rule."""
    n = int(ids.max(initial=-1)) + 1
    times = np.bincount(ids, minlength=n)
    single = times[ids] == 1
    at = np.flatnonzero(~single)
    g = Grammar(n, ids[at].astype(np.int64), at, np.ones(len(at), np.int64))
    symbol = n
    while len(g.symbols) > 1:
        # Places end where the next symbol of the same stretch begins.
        free = g.places[:-1] + g.lengths[:-1] == g.places[1:]
        key = g.symbols[:-1] * (symbol + 1) + g.symbols[1:]
        chosen = _positions_to_replace(key, free, g.lengths)
        if not len(chosen):
            break
        symbol = _replaced(g, chosen, key, symbol)
    while len(g.symbols) > 1:
        free = g.places[:-1] + g.lengths[:-1] == g.places[1:]
        if not free.any():
            break
        begins = np.concatenate(([True], ~free))
        number = np.arange(len(g.symbols))
        number -= np.maximum.accumulate(np.where(begins, number, 0))
        key = g.symbols[:-1] * (symbol + 1) + g.symbols[1:]
        symbol = _replaced(g, np.flatnonzero(free & (number[:-1] % 2 == 0)), key, symbol)
    return g


def _derived(g: Grammar, shortest: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per round, last first: nonterminal, place, words left of the boundary and all words, one row per place.

    Only nonterminals of at least `shortest` words: shorter ones hold no run and derive none that does."""
    total = sum(len(left) for _, left, _ in g.rules)
    length = np.ones(g.terminals + total, np.int64)
    for start, left, right in g.rules:
        length[start:start + len(left)] = length[left] + length[right]
    long = (g.symbols >= g.terminals) & (length[g.symbols] >= shortest)
    symbols, places = g.symbols[long], g.places[long]
    rounds = []
    for start, left, right in reversed(g.rules):
        mine = symbols >= start
        own, at = symbols[mine], places[mine]
        symbols, places = symbols[~mine], places[~mine]
        if not len(own):
            continue
        a, b = left[own - start], right[own - start]
        rounds.append((own, at, length[a], length[own]))
        below, where = np.concatenate((a, b)), np.concatenate((at, at + length[a]))
        long = (below >= g.terminals) & (length[below] >= shortest)
        symbols, places = np.concatenate((symbols, below[long])), np.concatenate((places, where[long]))
    return rounds


def _across(ids: np.ndarray, hashes: Hashes, similar: np.ndarray, width: int, start: np.ndarray, left: np.ndarray,
            length: np.ndarray, shortest: int) -> tuple[np.ndarray, ...]:
    """Runs across the boundary `left` words into each of the given stretches: stretch, from, to and period.

    `from` and `to` count from the stretch's start; runs end with the stretch."""
    found = [[], [], [], []]
    end, boundary = start + length, start + left
    # The word that a candidate period must bring back: at the boundary, from the left; before it, from the right.
    for back in (True, False):
        reach = np.minimum(left if back else length - left, length // 2)
        for group, item in blocks(reach):
            period = item + 1
            a = boundary[group] - (period if back else 1)
            # For a stretch of at least `width` equal words around a, one of these windows is equal.
            near = np.flatnonzero(ids[a] == ids[a + period])
            group, period, a = group[near], period[near], a[near]
            equal = np.zeros(len(a), bool)
            for k in range(width):
                at = np.maximum(a - k, 0)
                equal |= similar[at] == similar[at + period]
            group, period, a = group[equal], period[equal], a[equal]
            begin = a - hashes.stretch(a, a + period, a - start[group], back=True)
            stop = a + hashes.stretch(a, a + period, end[group] - period - a, back=False) + period
            whole = stop - begin >= np.maximum(shortest, 2 * period)
            for kept, values in zip(found, (group, begin - start[group], stop - start[group], period)):
                kept.append(values[whole])
    runs = [np.concatenate(kept) if kept else np.zeros(0, np.int64) for kept in found]
    # Multiples of a period, and runs found from both sides, share their interval.
    order = np.lexsort((runs[3], runs[2], runs[1], runs[0]))
    group, begin, stop, period = (column[order] for column in runs)
    smallest = np.ones(len(group), bool)
    smallest[1:] = (group[1:] != group[:-1]) | (begin[1:] != begin[:-1]) | (stop[1:] != stop[:-1])
    group, begin, stop, period = group[smallest], begin[smallest], stop[smallest], period[smallest]
    for run, item in blocks(stop - begin - period):
        at = start[group[run]] + begin[run] + item
        if not np.array_equal(ids[at], ids[at + period[run]]):
            raise Collision
    return group, begin, stop, period


def _runs_of(ids: np.ndarray, g: Grammar, hashes: Hashes, width: int, shortest: int) -> tuple[np.ndarray, ...]:
    """Start, end and period of all runs: those across each nonterminal's boundary, at all its places."""
    similar = windows(ids, width)
    starts, ends, periods = ([np.zeros(0, np.int64)] for _ in range(3))
    for symbol, place, left, length in _derived(g, shortest):
        _, first, which = np.unique(symbol, return_index=True, return_inverse=True)
        owner, begin, stop, period = _across(ids, hashes, similar, width, place[first], left[first], length[first],
                                             shortest)
        # All places of each nonterminal beside each of its runs.
        by_symbol = np.argsort(which, kind="stable")
        times = np.bincount(which, minlength=len(first))
        offset = np.cumsum(times) - times
        for run, number in blocks(times[owner]):
            at = place[by_symbol[offset[owner[run]] + number]]
            s, e, q = at + begin[run], at + stop[run], period[run]
            longer = (s > 0) & (ids[s - 1] == ids[s - 1 + q])
            longer |= (e < len(ids)) & (ids[np.minimum(e, len(ids) - 1)] == ids[e - q])
            starts.append(s[~longer])
            ends.append(e[~longer])
            periods.append(q[~longer])
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(periods)


def find_runs(ids: np.ndarray, text_of: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, ...]:
    """Start, end and period of all runs, by start and period. Ids between two texts must occur once."""
    width = max(1, (shortest + 1) // 2)
    masked = mask_single(ids, text_of, width)
    g = grammar(masked)
    for attempt in count():
        try:
            s, e, q = _runs_of(masked, g, Hashes(masked, attempt), width, shortest)
            break
        except Collision:
            continue
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Number of runs, the greatest one, all runs and the words without their repeats."""
    lines = b"".join(b"%d,%d,%d\n" % run for run in runs)
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2])) if runs else (None, None, None)
    kept = words
    if runs:
        repeats = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            repeats[start + period] += 1
            repeats[start + length] -= 1
        kept = [word for word, depth in zip(words, np.cumsum(repeats).tolist()) if not depth]
    return len(runs), *best, lines, b" ".join(kept)


def rows_of(some: list[list[bytes]], shortest: int = SHORTEST) -> list[tuple]:
    """Of each list of words: number of runs, the greatest run, lines of all runs, the text without repeats."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    ids, sizes = [], []
    for words in some:
        ids += [known[word] for word in words]
        sizes.append(len(words))
        # One word between two texts, of an id that nothing else has.
        ids.append(-1)
    flat = np.array(ids, np.int64)
    between = np.flatnonzero(flat < 0)
    flat[between] = len(known) + np.arange(len(between))
    offset = np.cumsum([0] + [size + 1 for size in sizes])
    text_of = np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64) + 1)
    s, e, q = find_runs(flat, text_of, shortest)
    cut = np.searchsorted(s, offset)
    rows = []
    for number, words in enumerate(some):
        mine = slice(cut[number], cut[number + 1])
        runs = list(zip((s[mine] - offset[number]).tolist(), (e[mine] - s[mine]).tolist(), q[mine].tolist()))
        rows.append(_row(words, runs))
    return rows


FOUND = [T.StructField("n_runs", T.LongType()), T.StructField("start", T.LongType()),
         T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]


def _mapped(docs: DataFrame, shortest: int, reword: Reword | None, more: list[T.StructField],
            columns: Callable[[list[tuple]], list[list]]) -> DataFrame:
    schema = T.StructType([docs.select("doc_id").schema[0], *FOUND, *more])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = column_of(batch, "doc_id")
        words = [text.encode().split() for text in texts(batch)]
        if reword:
            words = [reword(doc_id, some) for doc_id, some in zip(ids.to_pylist(), words)]
        rows = rows_of(words, shortest)
        found = [pa.array([row[k] for row in rows], pa.int64()) for k in range(4)]
        return pa.RecordBatch.from_arrays([ids, *found, *map(pa.array, columns(rows))], names=schema.names)

    return map_texts(docs.select("doc_id", "text"), run, schema)


def detect(docs: DataFrame, shortest: int = SHORTEST, reword: Reword | None = None) -> DataFrame:
    """doc_id, n_runs, the greatest run, `runs` (lines of start, length and period) and `collapsed`: the text
    without the words that repeat an earlier period. `reword` changes a text's words before."""
    return _mapped(docs, shortest, reword,
                   [T.StructField("runs", T.StringType()), T.StructField("collapsed", T.StringType())],
                   lambda rows: [[row[4].decode() for row in rows], [row[5].decode() for row in rows]])


def digests(docs: DataFrame, shortest: int = SHORTEST, reword: Reword | None = None) -> DataFrame:
    """As `detect`, with the exponent in thousandths, and SHA-256 digests instead of the texts."""
    more = [T.StructField("exponent_milli", T.LongType()), T.StructField("runs_sha256", T.StringType()),
            T.StructField("collapsed_sha256", T.StringType())]

    def columns(rows: list[tuple]) -> list:
        exponent = [None if row[3] is None else 1000 * row[2] // row[3] for row in rows]
        return [pa.array(exponent, pa.int64()), [hashlib.sha256(row[4]).hexdigest() for row in rows],
                [hashlib.sha256(row[5]).hexdigest() for row in rows]]

    return _mapped(docs, shortest, reword, more, columns)
