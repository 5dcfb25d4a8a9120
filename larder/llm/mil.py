"""A quality classifier by attention over passages (multiple-instance learning).

Every text is cut into passages of PASSAGE_WORDS words, each encoded by the shares of its character classes
and class pairs, its word length, stutter and variety. A hidden layer, gated attention and a logistic output
are trained together from the documents' labels alone; a document's score weighs all its passages by attention.
Training takes at most `rows` labelled documents (those with the smallest hash of their id) and all their passages: of a
text of more than TRAIN_GROUPS passages, neighbouring ones are averaged into that many groups, which bounds what
comes to the driver and leaves no passage out. Scoring takes every passage of every whole text by itself.

Results for odd input: a null or empty text has no passage and gets the score of an empty bag (the output's bias);
null ids are scored and are never trained on, nor are null labels; repeated rows get equal scores; without labels the score
is 0.5; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, fold_of, map_texts, text_slices, texts

PASSAGE_WORDS = 32
TRAIN_ROWS = 3000
TRAIN_GROUPS = 256
HIDDEN = 16
ATTENTION = 8
EPOCHS = 15
BATCH = 128
RATE = 0.01
DECAY = 1e-4

# Classes of UTF-8 bytes: all others are class 0 (remaining ASCII), the last two are lead and later bytes.
_SPACE = 1
_CLASSES = ["", " \t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:",
            "!?", "#*$%&<>", "|"]
N_CLASSES = len(_CLASSES) + 2
_CLASS_OF = np.zeros(256, np.uint8)
for _number, _chars in enumerate(_CLASSES):
    _CLASS_OF[[ord(c) for c in _chars]] = _number
_CLASS_OF[0x80:0xC0] = N_CLASSES - 1
_CLASS_OF[0xC0:] = N_CLASSES - 2
FEATURES = N_CLASSES * N_CLASSES + 3
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15 | 1, np.uint64))


def encode(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and each text's number of passages."""
    encoded = [t.encode() for t in some]
    ends = np.cumsum([0] + [len(e) + 1 for e in encoded])
    data = np.frombuffer(b" ".join(encoded) + b"  ", np.uint8)
    kinds = _CLASS_OF[data]
    solid = kinds != _SPACE
    starts = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    if not len(starts):
        return np.zeros((0, FEATURES), np.float32), np.zeros(len(some), np.int64)
    owner = np.searchsorted(ends, starts, side="right") - 1
    words = np.bincount(owner, minlength=len(some))
    counts = -(-words // PASSAGE_WORDS)
    bases = np.cumsum(counts) - counts
    first = np.cumsum(words) - words
    passage = bases[owner] + (np.arange(len(starts)) - first[owner]) // PASSAGE_WORDS
    n = int(counts.sum())
    at = np.flatnonzero(solid)
    word = np.searchsorted(starts, at, side="right") - 1
    of_byte = passage[word]
    pairs = kinds[at].astype(np.int64) * N_CLASSES + kinds[at + 1]
    shares = np.bincount(of_byte * N_CLASSES**2 + pairs, minlength=n * N_CLASSES**2).reshape(n, -1).astype(np.float32)
    sizes = shares.sum(axis=1, keepdims=True)
    in_passage = np.bincount(passage, minlength=n).astype(np.float32)
    # A hash of each word, to see repeats.
    weighed = (data[at].astype(np.uint64) + np.uint64(1)) * _POWERS[(at - starts[word]) % 64]
    hashes = np.add.reduceat(weighed, np.searchsorted(at, starts))
    same = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    stutter = np.bincount(passage[1:], weights=same, minlength=n)
    order = np.lexsort((hashes, passage))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    variety = np.bincount(passage[order], weights=new, minlength=n)
    extra = np.stack([sizes[:, 0] / in_passage / 10, stutter / in_passage, variety / in_passage], axis=1)
    return np.concatenate([np.sqrt(shares / sizes), extra], axis=1).astype(np.float32), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """Weights of the network; `forward` works on bags that lie one after the other, none of them empty."""

    NAMES = ("hidden", "hidden_bias", "value", "gate", "attention", "output", "bias")

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.hidden = rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN))
        self.hidden_bias = np.zeros(HIDDEN)
        self.value = rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION))
        self.gate = rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION))
        self.attention = rng.normal(0, ATTENTION**-0.5, ATTENTION)
        self.output = np.zeros(HIDDEN)
        self.bias = np.zeros(1)

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        starts = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh((x - self.mean) / self.scale @ self.hidden + self.hidden_bias)
        value, gate = np.tanh(h @ self.value), _sigmoid(h @ self.gate)
        energy = (value * gate) @ self.attention
        raised = np.exp(energy - np.maximum.reduceat(energy, starts)[bag])
        weight = raised / np.add.reduceat(raised, starts)[bag]
        pooled = np.add.reduceat(weight[:, None] * h, starts)
        return {"h": h, "value": value, "gate": gate, "weight": weight, "pooled": pooled, "bag": bag, "starts": starts,
                "score": _sigmoid(pooled @ self.output + self.bias)}

    def gradients(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log-loss."""
        f = self.forward(x, counts)
        h, value, gate, weight, bag = f["h"], f["value"], f["gate"], f["weight"], f["bag"]
        miss = (f["score"] - labels) / len(labels)
        pooled = (miss[:, None] * self.output)[bag]
        by_weight = (h * pooled).sum(axis=1)
        energy = weight * (by_weight - np.add.reduceat(weight * by_weight, f["starts"])[bag])
        both = energy[:, None] * self.attention
        by_value, by_gate = both * gate * (1 - value**2), both * value * gate * (1 - gate)
        by_h = weight[:, None] * pooled + by_value @ self.value.T + by_gate @ self.gate.T
        before = by_h * (1 - h**2)
        return {"hidden": ((x - self.mean) / self.scale).T @ before, "hidden_bias": before.sum(axis=0),
                "value": h.T @ by_value, "gate": h.T @ by_gate, "attention": (value * gate).T @ energy,
                "output": f["pooled"].T @ miss, "bias": miss.sum(keepdims=True)}

    def fit(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> None:
        """Adam over shuffled batches of bags."""
        if not len(counts):
            return
        self.mean = x.mean(axis=0)
        self.scale = np.maximum(x.std(axis=0), 1e-2)
        starts = np.cumsum(counts) - counts
        rng = np.random.default_rng(seed)
        first = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        second = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(counts))
            for at in range(0, len(order), BATCH):
                some = order[at:at + BATCH]
                rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in some])
                step += 1
                for name, gradient in self.gradients(x[rows], counts[some], labels[some]).items():
                    weight = getattr(self, name)
                    gradient = gradient + DECAY * weight
                    first[name] = 0.9 * first[name] + 0.1 * gradient
                    second[name] = 0.999 * second[name] + 0.001 * gradient**2
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, name, weight - RATE * change)

    def score(self, some: list[str]) -> np.ndarray:
        """Scores of whole texts."""
        x, counts = encode(some)
        scores = np.full(len(some), _sigmoid(self.bias)[0])
        full = counts > 0
        if full.any():
            scores[full] = self.forward(x, counts[full])["score"]
        return scores


def grouped(x: np.ndarray, most: int = TRAIN_GROUPS) -> np.ndarray:
    """The passages of a text, or the means of `most` groups of neighbouring ones if they are more."""
    if len(x) <= most:
        return x
    starts = np.arange(most) * len(x) // most
    return (np.add.reduceat(x, starts) / np.diff(np.r_[starts, len(x)])[:, None]).astype(np.float32)


def training_bags(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, held_out: int) -> DataFrame:
    """label and features (the passages' numbers, one passage after the other) of at most `rows` documents
    outside the held-out fold."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
    # At most `rows` ids and labels.
    chosen = usable.select("doc_id", F.col(label).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x, counts = encode(texts(batch))
            found = []
            for start, count in zip(np.cumsum(counts) - counts, counts):
                found.append(grouped(x[start:start + count]).tobytes())
            yield pa.RecordBatch.from_arrays([column_of(batch, "label"), pa.array(found, pa.binary())], names=schema.names)

    return picked.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, folds: int = 3,
          held_out: int = 1) -> GatedAttention:
    """A network fitted to at most `rows` labelled documents, whose bounded features come to the driver."""
    bags = training_bags(docs, labels, label, rows, folds, held_out).toArrow()
    bags = sorted(zip(bags.column("features").to_pylist(), bags.column("label").to_pylist()))
    bags = [(np.frombuffer(f, np.float32).reshape(-1, FEATURES), y) for f, y in bags if f]
    model = GatedAttention()
    if bags:
        model.fit(np.concatenate([x for x, _ in bags]), np.array([len(x) for x, _ in bags]),
                  np.array([y for _, y in bags], float))
    return model


def score(docs: DataFrame, model: GatedAttention, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(model.score(texts(batch)))], names=schema.names)

    scored = map_texts(docs.select("doc_id", "text"), run, schema)
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
