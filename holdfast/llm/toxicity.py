"""Toxicity: averaged subword embeddings in a linear softmax, trained jointly.

A word's vector is the mean of the embeddings of its character n-grams (3 to 5 characters, with marks at both ends), so a
misspelt word shares most of its vector with the right one.  Windows of words are averaged and go through a linear
softmax over (clean, toxic); a text is as toxic as its most toxic window, so that clean words around it change nothing.
Embeddings and softmax are trained together in numpy.  As all of it is linear up to the windows, a trained word is one number.

Words are runs of letters and digits (ASCII) and bytes of other characters, A-Z lower-cased.  Learns only from rows
whose crc32(doc_id as text) mod 4 is not 2; languages, sources and ids are no inputs.

Null and empty texts have no window and score 0; a very long text is scored in parts, whose greatest score is the text's;
texts that tie have equal scores; repeated rows are repeated; without labelled rows of both classes all
scores are 0; an empty table gives an empty result; other columns are ignored.
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
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 24 << 20
MODULUS, HELD = 4, 2
THRESHOLD = 0.3
BUCKETS, DIMENSIONS, WINDOW = 1 << 17, 8, 4
SHORTEST, LONGEST = 3, 5
#: Bytes of a text that are scored at once, and by which its parts may overlap.
PART_BYTES, OVERLAP = 4 << 20, 256
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"

_WORD_BYTES = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of each word in turn, and the number in each text."""
    lists = [t.translate(_WORD_BYTES) for t in texts]
    flat, counts = common.words_of(pa.array(lists, pa.binary()).cast(pa.string()), lower=False)
    coded = flat.cast(pa.binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words in turn, and the number in each word (1 at least)."""
    parts = [_subwords(words[i : i + 20_000]) for i in range(0, len(words), 20_000)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    marked = ["<" + w.decode("utf-8", "replace") + ">" for w in words]
    data = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(data)) - (ends - sizes)[owner]
    each = np.stack([np.maximum(sizes - n + 1, 0) for n in range(SHORTEST, LONGEST + 1)])
    counts = each.sum(0)
    places = np.cumsum(counts) - counts + np.cumsum(each, 0) - each  # of each word's first n-gram of each length
    slots, code = np.zeros(int(counts.sum()), np.int32), np.zeros(len(data), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(data) < n:
            break
        with np.errstate(over="ignore"):
            code[: len(data) - n + 1] = code[: len(data) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + data[n - 1 :]
        if n >= SHORTEST:
            inside = at + n <= sizes[owner]
            slots[places[n - SHORTEST][owner[inside]] + at[inside]] = ht.mixed(code[inside], n) >> (ht.BITS - 17)
    return slots, counts


class ToxicityModel:
    def __init__(self, embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray, slope: float = 1.0, offset: float = 0.0):
        """weights: DIMENSIONS x 2, bias: 2, for (clean, toxic)."""
        self.per_gram = (embeddings @ (weights[:, 1] - weights[:, 0])).astype(np.float32)
        self.bias, self.slope, self.offset = float(bias[1] - bias[0]), slope, offset

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Log odds of each text's most toxic window, -inf where there is no word."""
        distinct, index, counts = split_words(texts)
        slots, n = subwords(distinct)
        value = ht.sums(self.per_gram[slots], np.cumsum(n) - n, n) / np.maximum(n, 1)
        first, sizes = window_starts(counts)
        means = ht.sums(value[index], first, sizes) / np.maximum(sizes, 1)
        per_text = -(-counts // WINDOW)
        out = np.full(len(texts), -np.inf)
        full = per_text > 0
        if full.any():
            heads = (np.cumsum(per_text) - per_text)[full]
            out[full] = np.maximum.reduceat(means, heads) + self.bias
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        owner, parts = parts_of(texts)
        margin = np.full(len(texts), -np.inf)
        np.maximum.at(margin, owner, self.margins(parts))
        return np.where(np.isfinite(margin), ht.sigmoid(self.slope * np.where(np.isfinite(margin), margin, 0) + self.offset), 0.0)


def parts_of(texts: list[bytes], most: int = PART_BYTES) -> tuple[np.ndarray, list[bytes]]:
    """Texts cut before words so that no part is much longer than ``most`` bytes, each with a window's words of the part before
    it (a window of the whole text is in some part, if not at the same place); and the text of each part."""
    owner, parts = [], []
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > most + OVERLAP:
            cut = text.find(b" ", at + most, at + most + OVERLAP)
            cut = at + most if cut < 0 else cut
            owner.append(i)
            parts.append(text[at:cut])
            back = text.rfind(b" ", at, max(at, cut - OVERLAP))
            at = back if back > at else cut
        owner.append(i)
        parts.append(text[at:])
    return np.array(owner, np.int64), parts


def window_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of WINDOW words (a text's last may have fewer): first word and size."""
    per_text = -(-counts // WINDOW)
    owner = np.repeat(np.arange(len(counts)), per_text)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = (np.cumsum(counts) - counts)[owner] + rank * WINDOW
    return starts, np.minimum(WINDOW, counts[owner] - rank * WINDOW)


def fit(texts: list[bytes], y: np.ndarray, epochs: int = 7, batch: int = 64, seed: int = 5) -> ToxicityModel:
    """Joint training with Adagrad.  The most toxic window is softened here: the gradient of a text's loss goes to its windows by
    their softmax share."""
    rng = np.random.Generator(np.random.PCG64(seed))
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights, bias = rng.normal(0, 0.5, (DIMENSIONS, 2)), np.array([2.0, -2.0])
    e_sum, w_sum, b_sum = np.full(BUCKETS, 1e-6), 1e-6, 1e-6
    distinct, index, counts = split_words(texts)
    slots, n = subwords(distinct)
    first_slot, first_word = np.cumsum(n) - n, np.cumsum(counts) - counts
    for epoch in range(epochs):
        rate = 1.0 / (1 + 0.1 * epoch)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            ids = order[at : at + batch]
            ids = ids[counts[ids] > 0]
            if not len(ids):
                continue
            words = index[common.ragged(first_word[ids], counts[ids])]
            own, inverse = np.unique(words, return_inverse=True)
            grams = slots[common.ragged(first_slot[own], n[own])]
            starts = np.cumsum(n[own]) - n[own]
            vectors = np.add.reduceat(embeddings[grams], starts) / n[own][:, None]
            first, sizes = window_starts(counts[ids])
            windows = np.add.reduceat(vectors[inverse], first) / sizes[:, None]
            per = -(-counts[ids] // WINDOW)
            heads, owner = np.cumsum(per) - per, np.repeat(np.arange(len(ids)), per)
            logits = windows @ weights + bias
            margin = logits[:, 1] - logits[:, 0]
            top = np.maximum.reduceat(margin, heads)
            share = np.exp(margin - top[owner])
            total = np.add.reduceat(share, heads)
            share /= total[owner]
            pooled = top + np.log(total)
            error = (ht.sigmoid(pooled) - y[ids]) / len(ids)
            d_margin = share * error[owner]
            d_logits = np.stack([-d_margin, d_margin], 1)
            d_weights, d_bias = windows.T @ d_logits, d_logits.sum(0)
            d_windows = (d_logits @ weights.T) / sizes[:, None]
            d_words = np.repeat(d_windows, sizes, axis=0)
            d_own = np.stack([np.bincount(inverse, d_words[:, k], len(own)) for k in range(DIMENSIONS)], 1) / n[own][:, None]
            spread = np.repeat(d_own, n[own], axis=0)
            d_grams = np.stack([np.bincount(grams, spread[:, k], BUCKETS) for k in range(DIMENSIONS)], 1)
            e_sum += (d_grams**2).sum(1)
            embeddings -= rate * d_grams / np.sqrt(e_sum)[:, None]
            w_sum, b_sum = w_sum + (d_weights**2).sum(), b_sum + (d_bias**2).sum()
            weights -= 0.5 * rate * d_weights / np.sqrt(w_sum)
            bias -= 0.5 * rate * d_bias / np.sqrt(b_sum)
    return ToxicityModel(embeddings, weights, bias)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> ToxicityModel | None:
    """Fit on four fifths of the sample; calibrate on the rest."""
    learn = (common.fold("doc_id", MODULUS) != HELD) & F.col("toxic").isNotNull()
    table = ht.labelled_sample(docs, labels, learn, ["toxic"], rows, max_bytes)
    y = (table.column("toxic").to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    texts = common.text_bytes(table.column("text").combine_chunks())
    apart = np.arange(len(y)) % 5 == 4
    model = fit([t for t, a in zip(texts, apart, strict=True) if not a], y[~apart])
    margins = model.margins([t for t, a in zip(texts, apart, strict=True) if a])
    there = np.isfinite(margins)
    model.slope, model.offset = ht.platt(margins[there], y[apart][there])
    return model


def score(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=4 << 20):
            chance = model.score(common.text_bytes(batch.column("text"))) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": chance, "predicted": (chance >= threshold).astype(np.int32)}
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (common.fold("doc_id", MODULUS) == HELD).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, SCHEMA)


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op5."""
    return score(docs, train(docs, labels))
