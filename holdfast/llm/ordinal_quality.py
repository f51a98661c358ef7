"""Quality classifier on graded ratings: a cumulative-link (proportional odds) model.

P(grade <= k) = sigmoid(threshold_k - score); one set of hashed-text weights gives the score of all grades, and the
thresholds are ordered.  Grades of a labelled document: 0 for low quality, 1 for good quality but toxic text, 2 for
good quality and clean.  A document's expected grade ranks it; the tail probability P(grade >= 1) selects it.

Learns only from rows whose crc32(doc_id as text) mod 4 is not 2.  Null and empty texts are scored by the bias alone;
repeated rows are repeated; without labelled rows of two grades all tail probabilities are 1; an empty table gives an
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

#: Bounds of the labelled sample: rows, bytes of text.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 24 << 20
MODULUS, HELD = 4, 2
GRADES = 3
#: Kept: at least this probability of grade TAIL or more.
TAIL, THRESHOLD = 1, 0.5

SCHEMA = "doc_id bigint, held_out boolean, expected_grade double, tail_prob double, kept boolean"


class OrdinalModel:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES - 1."""
        return 1 - ht.sigmoid(self.thresholds[None, :] - scores[:, None])


def fit_ordinal(x: ht.Sparse, grades: np.ndarray, n_grades: int = GRADES, steps: int = 150, rate: float = 0.05, decay: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood by Adam; thresholds are a first value and positive steps, so they stay ordered."""
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(1, len(grades)), 0.01, 0.99)
    start = np.log(share / (1 - share))
    weights, free, adam = np.zeros(ht.SIZE), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))]), ht.Adam(rate)
    edges = lambda f: np.cumsum(np.concatenate([f[:1], np.exp(np.clip(f[1:], -6, 6))]))
    for _ in range(steps):
        theta = edges(free)
        scores = x.dot(weights)
        below = ht.sigmoid(theta[None, :] - scores[:, None])
        padded = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        row = np.arange(len(scores))
        chance = np.maximum(padded[row, grades + 1] - padded[row, grades], 1e-9)
        slope = padded * (1 - padded)
        upper, lower = slope[row, grades + 1] / chance, slope[row, grades] / chance
        d_score = (upper - lower) / len(scores)  # of the negative log likelihood
        d_theta = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            d_theta[k] = (-upper[grades == k].sum() + lower[grades == k + 1].sum()) / len(scores)
        tail = np.cumsum(d_theta[::-1])[::-1]
        d_free = np.concatenate([tail[:1], tail[1:] * np.exp(np.clip(free[1:], -6, 6))])
        weights = adam.step("w", weights, x.transposed_dot(d_score) + decay * weights)
        free = adam.step("t", free, d_free)
        adam.t += 1
    return OrdinalModel(weights, edges(free))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> OrdinalModel | None:
    learn = (common.fold("doc_id", MODULUS) != HELD) & F.col("quality").isNotNull()
    table = ht.labelled_sample(docs, labels, learn, ["quality", "toxic"], rows, max_bytes)
    good = table.column("quality").to_numpy() > 0
    toxic = table.column("toxic").fill_null(0).to_numpy() > 0
    grades = np.where(good, np.where(toxic, 1, 2), 0)
    if len(np.unique(grades)) < 2:
        return None
    return fit_ordinal(ht.Sparse(ht.sample_rows(table)), grades)


def grade(docs: DataFrame, model: OrdinalModel | None, tail: int = TAIL, threshold: float = THRESHOLD) -> DataFrame:
    """Expected grade and tail probability of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            tails = model.tails(ht.Parts(batch.column("text")).score(model.weights, 0.0)) if model else np.ones((batch.num_rows, GRADES - 1))
            chance = tails[:, tail - 1]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "expected_grade": tails.sum(1), "tail_prob": chance, "kept": chance >= threshold}
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (common.fold("doc_id", MODULUS) == HELD).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, SCHEMA)


def graded_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: every document's grades."""
    return grade(docs, train(docs, labels))
