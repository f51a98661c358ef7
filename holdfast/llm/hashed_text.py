"""Hashed word and character n-grams of whole texts, and linear models over their means.

A text's score is the sum, over four kinds of n-gram (single words, word pairs, three and four bytes), of the mean
weight of its n-grams of that kind.  Words are `[^\\x20\\x09-\\x0D]+`, case kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 18
SIZE = 1 << BITS
#: Widths of byte n-grams, and places of a text that are looked at together.
BYTES, PIECE = (3, 4), 1 << 20
#: Means of many n-grams are small; scaling them speeds up training.
SCALE = 16.0

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Spread 64-bit values over the table."""
    with np.errstate(over="ignore"):
        x = (values.astype(np.uint64) + np.uint64(salt)) * _MULTIPLIER
        x ^= x >> np.uint64(29)
        return ((x * _MULTIPLIER) >> np.uint64(64 - BITS)).astype(np.int64)


class Parts:
    """Words and bytes of a slice of texts."""

    def __init__(self, column: pa.Array):
        self.texts = common.text_bytes(column)
        flat, self.words = common.words_of(column, lower=False)
        coded = flat.cast(pa.binary()).dictionary_encode()
        self.distinct = coded.dictionary.to_pylist()
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.word_ends = np.cumsum(self.words)
        self.word_starts = self.word_ends - self.words
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.sizes = sizes
        # three separators after each text keep its byte n-grams apart from the next text's
        self.data = np.frombuffer(b"\n\n\n".join(self.texts) + b"\n\n\n", np.uint8)
        self.byte_starts = np.cumsum(sizes + 3) - sizes - 3

    def word_grams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of single words, then of pairs: table slots of all n-grams in order, each text's first, and its number."""
        hashes = np.fromiter((zlib.crc32(w) | len(w) << 32 for w in self.distinct), np.uint64, len(self.distinct))
        yield mixed(hashes, 1)[self.index], self.word_starts, self.words
        pairs = np.maximum(self.words - 1, 0)
        with np.errstate(over="ignore"):
            both = hashes[self.index[:-1]] * np.uint64(0x100000001B3) + hashes[self.index[1:]] if len(self.index) > 1 else np.zeros(0, np.uint64)
        both[self.index[:-1] == self.index[1:]] = 0  # a word repeated at once is one feature, whatever the word
        inside = np.ones(len(both), bool)
        cut = self.word_ends[:-1] - 1
        inside[cut[(cut >= 0) & (cut < len(both))]] = False
        yield mixed(both, 2)[inside], np.cumsum(pairs) - pairs, pairs

    def byte_slots(self, width: int, start: int, end: int) -> np.ndarray:
        """Table slots of the n-grams of ``width`` bytes that begin at these places."""
        data = self.data[start : end + width - 1].astype(np.uint32)
        code = np.zeros(max(len(data) - width + 1, 0), np.uint32)
        for i in range(width):
            code |= data[i : i + len(code)] << np.uint32(8 * i)
        return mixed(code, width)

    def score(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """Bytes are taken in pieces, so that a long text needs few bytes of memory for each of its own."""
        total = np.full(len(self.texts), bias)
        for slots, starts, counts in self.word_grams():
            total += SCALE * sums(weights[slots], starts, counts) / np.maximum(counts, 1)
        ends = self.byte_starts + self.sizes
        for width in BYTES:
            values = np.zeros(len(self.data), weights.dtype)
            for i in range(0, len(self.data), PIECE):
                own = self.byte_slots(width, i, min(i + PIECE, len(self.data)))
                values[i : i + len(own)] = weights[own]
            for i in range(3):
                values[ends + i] = 0
            total += SCALE * np.where(self.sizes > 0, sums(values, self.byte_starts, self.sizes + 3), 0) / np.maximum(self.sizes, 1)
        return total

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's table slots and mean values."""
        grams = list(self.word_grams())
        keep = np.ones(len(self.data), bool)
        for i in range(3):
            keep[self.byte_starts + self.sizes + i] = False
        for width in BYTES:
            slots = self.byte_slots(width, 0, len(self.data))
            grams.append((slots[keep[: len(slots)]], np.cumsum(self.sizes) - self.sizes, self.sizes))
        out = []
        for i in range(len(self.texts)):
            slots, values = [], []
            for all_slots, starts, counts in grams:
                if counts[i]:
                    found, n = np.unique(all_slots[starts[i] : starts[i] + counts[i]], return_counts=True)
                    slots.append(found.astype(np.int32))
                    values.append((SCALE * n / counts[i]).astype(np.float32))
            out.append((np.concatenate(slots), np.concatenate(values)) if slots else (np.zeros(0, np.int32), np.zeros(0, np.float32)))
        return out


def sums(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs, 0 for empty ones."""
    out = np.zeros(len(starts))
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], dtype=np.float64)
    return out


class Sparse:
    """Rows of (slots, values)."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.counts = np.array([len(s) for s, _ in rows], np.int64)
        self.slots = np.concatenate([s for s, _ in rows]) if rows else np.zeros(0, np.int32)
        self.values = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)
        self.starts = np.cumsum(self.counts) - self.counts

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.counts))
        for i in range(0, len(out), 256):
            own = slice(i, i + 256)
            part = slice(self.starts[i], self.starts[i] + int(self.counts[own].sum()))
            out[own] = sums(weights[self.slots[part]] * self.values[part], self.starts[own] - self.starts[i], self.counts[own])
        return out

    def transposed_dot(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(SIZE)
        for i in range(0, len(self.counts), 256):  # a part at a time keeps temporary arrays small
            part = slice(self.starts[i], self.starts[i] + int(self.counts[i : i + 256].sum()))
            out += np.bincount(self.slots[part], self.values[part] * np.repeat(rows[i : i + 256], self.counts[i : i + 256]), SIZE)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.state = rate, 0, {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        m, v = self.state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        self.state[name] = (m, v)
        t = self.t + 1
        return value - self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def fit_logistic(x: Sparse, y: np.ndarray, steps: int = 120, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    weights, bias, adam = np.zeros(SIZE), np.zeros(1), Adam(rate)
    for _ in range(steps if len(y) else 0):
        error = (sigmoid(x.dot(weights) + bias[0]) - y) / len(y)
        weights = adam.step("w", weights, x.transposed_dot(error) + decay * weights)
        bias = adam.step("b", bias, np.array([error.sum()]))
        adam.t += 1
    return weights, float(bias[0])


def platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make sigmoid(slope * score + offset) a probability, by Newton steps on smoothed targets."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    positive = y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * scores + b)
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(g * scores).sum(), g.sum()]) + np.array([1e-3 * (a - 1), 0.0])
        hessian = np.array([[(h * scores**2).sum() + 1e-3, (h * scores).sum()], [(h * scores).sum(), h.sum() + 1e-9]])
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 2.0 / max(1e-12, float(np.abs(move).max())))
        a, b = a - move[0], b - move[1]
    return float(max(a, 1e-3)), float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, wanted: Column, columns: list[str], rows: int, max_bytes: int) -> pa.Table:
    """Whole texts of at most ``rows`` labelled documents and ``max_bytes``, in hash order of doc_id: text and ``columns``.

    Both bounds hold the classifiers' training data within the driver's memory.
    """
    known = labels.where(wanted & F.col("doc_id").isNotNull()).select("doc_id", *columns)
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sizes = texts.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("n"))
    left, keep = max_bytes, []
    for row in sizes.orderBy(F.xxhash64("doc_id")).collect():  # at most ``rows``
        if row["n"] <= left:
            left -= row["n"]
            keep.append((row["doc_id"],))
    spark = docs.sparkSession
    kept = spark.createDataFrame(keep, "doc_id bigint")
    chosen = picked.join(F.broadcast(kept), "doc_id", "left_semi")
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *columns).toArrow()
    return found.sort_by([(c, "ascending") for c in ["doc_id", *columns, "text"]])


def sample_rows(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for part in common.slices(table.to_batches()):
        rows += Parts(part.column("text")).rows()
    return rows
