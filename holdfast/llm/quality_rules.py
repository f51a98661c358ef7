"""Quality rules: exact counts of a text, and a calibrated classifier's verdict.

The classifier is logistic regression over hashed word and character n-grams, trained on labelled quality rows and
calibrated on rows that it did not see.  Texts are scored in Arrow batches.

Null texts have no words (all counts 0, so they fail the base rule); equal texts get equal rows, repeated rows are
repeated; with no labelled row of both classes every text that passes the base rule is kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from . import hashed_text as ht

#: Bounds of the labelled sample: rows, bytes of text.  A third of it calibrates.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 24 << 20
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Kept: at least this probability of good quality.
THRESHOLD = 0.5
SYMBOLS = b"#*$%&|<>"

SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, quality_prob double, kept boolean"

_SPACE = b" \t\n\v\f\r"
_IS_SYMBOL = np.zeros(256, np.int8)
_IS_SYMBOL[list(SYMBOLS)] = 1
_STARTS_CHAR = np.ones(256, np.int8)
_STARTS_CHAR[0x80:0xC0] = 0
_STARTS_CHAR[list(_SPACE)] = 0


class QualityModel:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset

    def probability(self, parts: ht.Parts) -> np.ndarray:
        return ht.sigmoid(self.slope * parts.score(self.weights, self.bias) + self.offset)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> QualityModel | None:
    table = ht.labelled_sample(docs, labels, F.col("quality").isNotNull(), ["quality"], rows, max_bytes)
    y = (table.column("quality").to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    features = ht.sample_rows(table)
    apart = np.arange(len(y)) % 3 == 2
    fitted, held = np.flatnonzero(~apart), np.flatnonzero(apart)
    weights, bias = ht.fit_logistic(ht.Sparse([features[i] for i in fitted]), y[fitted])
    slope, offset = ht.platt(ht.Sparse([features[i] for i in held]).dot(weights) + bias, y[held])
    return QualityModel(weights, bias, slope, offset)


def repeated_words(words: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    if distinct < 1 << 21:
        code = (words[:-2] * distinct + words[1:-1]) * distinct + words[2:]
    else:
        pair = np.unique(words[:-2] * distinct + words[1:-1], return_inverse=True)[1]
        code = pair * distinct + words[2:]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    hit = np.zeros(n, bool)
    for i in range(3):
        hit[i : n - 2 + i] |= twice
    return int(hit.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip(_SPACE):
            if line in seen:
                n += 1
            seen.add(line)
    return n


def measure(parts: ht.Parts) -> dict[str, np.ndarray]:
    n = len(parts.texts)
    counts = {"n_words": parts.words}
    for name, kind in (("word_chars", _STARTS_CHAR), ("n_symbols", _IS_SYMBOL)):
        counts[name] = np.add.reduceat(kind[parts.data], parts.byte_starts, dtype=np.int64) if n else np.zeros(0, np.int64)
    counts["n_dup_lines"] = np.array([duplicate_lines(t) for t in parts.texts], np.int64)
    distinct = len(parts.distinct) or 1
    counts["n_repeat_words"] = np.array(
        [repeated_words(parts.index[s:e], distinct) for s, e in zip(parts.word_starts, parts.word_ends, strict=True)], np.int64
    )
    counts["base_failed"] = (parts.words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * parts.words)
    return counts


def apply_rules(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            parts = ht.Parts(batch.column("text"))
            counts = measure(parts)
            chance = model.probability(parts) if model else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id")} | counts | {"quality_prob": chance, "kept": ~counts["base_failed"] & (chance >= threshold)}
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op10."""
    return apply_rules(docs, train(docs, labels))
