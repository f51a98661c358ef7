"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1.  An n-gram of letters is bound from them: the product of its letters'
vectors, each rotated by its place.  A text's vector is the sum (bundle) of those of its n-grams; a language's
prototype is the sum over its training texts, less the mean of all prototypes.  A text belongs to the language whose
prototype has the largest cosine with it.

Letters are lower-cased; anything else is one boundary.  A letter's vector comes from its code point alone, so that letters of
all scripts have their own.  Learns from text and non-null lang of rows whose crc32(doc_id as text) mod 4 is not 2.

Null texts and texts without a letter are ``und`` with score 0, as is everything if no row can be learnt from; ties go
to the first language by code point; repeated rows are repeated; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

DIMENSIONS, NGRAM = 1024, 3
MODULUS, HELD = 4, 2
UNDETERMINED = "und"
#: Texts whose vectors are made at once, and their bytes.
GROUP, GROUP_BYTES = 128, 1 << 20
#: Codes of n-grams that are counted in a table, and n-grams of a language that a task holds before it bundles them.
TABLE, HELD_GRAMS = 1 << 22, 1 << 17

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of +1 and -1 of code points, as int8 (0 is the boundary)."""
    lanes = np.arange(-(-dimensions // 64), dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + lanes * np.uint64(0xD1B54A32D192ED03) + np.uint64(8)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    bits = np.unpackbits((x ^ x >> np.uint64(31)).astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits[:, :dimensions].astype(np.int8) * 2 - 1


_IS_LETTER: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _IS_LETTER
    if _IS_LETTER is None:
        _IS_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _IS_LETTER


def ngram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all letter n-grams, the text that each is from, and the code points of the group's symbols, whose numbers make up
    the codes; n-grams without a letter in the middle are left out."""
    points = np.frombuffer(("\n".join(texts) + "\n").lower().encode("utf-32-le", "surrogatepass"), np.uint32) if texts else np.zeros(0, np.uint32)
    lengths = np.array([len(t.lower()) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[: len(points)]
    letter = letter_table()[points]
    alphabet = np.concatenate([[0], np.flatnonzero(np.bincount(points[letter]))]) if letter.any() else np.zeros(1, np.int64)
    number = np.zeros(int(alphabet[-1]) + 1, np.int32)
    number[alphabet] = np.arange(len(alphabet))
    symbols = np.zeros(len(points), np.int32)
    symbols[letter] = number[points[letter]]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0) | (owner[1:] != owner[:-1])
    symbols, owner = symbols[keep], owner[keep]
    # a boundary before each text's first letter as well
    starts = np.searchsorted(owner, np.arange(len(texts)))
    symbols, owner = np.insert(symbols, starts, 0), np.insert(owner, starts, np.arange(len(texts)))
    n = len(symbols) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), alphabet
    code = np.zeros(n, np.int64)
    for place in range(NGRAM):
        code = code * len(alphabet) + symbols[place : n + place]
    good = (owner[:n] == owner[NGRAM - 1 :]) & (symbols[1 : n + 1] != 0)
    return code[good], owner[:n][good], alphabet


def bound(codes: np.ndarray, alphabet: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of n-grams: each letter's rotated by its place."""
    letters, out = letter_vectors(alphabet, dimensions), np.ones((len(codes), dimensions), np.int8)
    for place in range(NGRAM - 1, -1, -1):
        out *= np.roll(letters, NGRAM - 1 - place, axis=1)[codes % len(alphabet)]
        codes = codes // len(alphabet)
    return out


def distinct_codes(codes: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, and the number of each."""
    if len(alphabet) ** NGRAM > TABLE:
        return np.unique(codes, return_inverse=True)
    distinct = np.flatnonzero(np.bincount(codes, minlength=1)) if len(codes) else np.zeros(0, np.int64)
    place = np.zeros(int(distinct[-1]) + 1 if len(distinct) else 1, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[codes]


def group_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of a group of texts, how often each text has each, and the alphabet."""
    codes, owner, alphabet = ngram_codes(texts)
    distinct, place = distinct_codes(codes, alphabet)
    counts = np.bincount(owner * len(distinct) + place, minlength=len(texts) * len(distinct))
    return distinct, counts.reshape(len(texts), len(distinct)).astype(np.float32), alphabet


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.drop_kept()
    for batch in common.slices(batches, limit=GROUP_BYTES):
        for start in range(0, batch.num_rows, GROUP):
            yield batch.slice(start, GROUP)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


class LanguageProfiles:
    def __init__(self, languages: list[str], sums: np.ndarray):
        """sums: a row of int64 for each language."""
        self.languages = languages
        unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12) if len(languages) else np.zeros((0, DIMENSIONS))
        self.mean = unit.mean(0) if len(languages) > 1 else np.zeros(sums.shape[1] if sums.ndim == 2 else DIMENSIONS)
        apart = unit - self.mean
        self.prototypes = (apart / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def cosines(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        apart = unit - self.mean
        return (apart @ self.prototypes.T) / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)


def train(docs: DataFrame, dimensions: int = DIMENSIONS) -> LanguageProfiles:
    """Prototypes from all training rows.  Tasks send one vector of counts' sums a language; whole numbers, so exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        sums: dict[str, np.ndarray] = {}

        def bundle(lang: str) -> None:
            points, totals = held.pop(lang)
            alphabet, number = np.unique(points, return_inverse=True)
            codes = np.zeros(len(points), np.int64)
            for place in range(NGRAM):
                codes = codes * len(alphabet) + number.reshape(points.shape)[:, place]
            for i in range(0, len(codes), 4096):
                sums[lang] = sums.get(lang, 0) + totals[i : i + 4096].astype(np.float64) @ bound(codes[i : i + 4096], alphabet, dimensions).astype(np.float64)

        def hold(lang: str, points: np.ndarray, totals: np.ndarray) -> None:
            """n-grams as code points, and their numbers."""
            if lang in held:
                packed = np.concatenate([held[lang][0], points]) @ (1 << 21 * np.arange(NGRAM - 1, -1, -1))
                distinct, place = np.unique(packed, return_inverse=True)
                totals = np.bincount(place, np.concatenate([held[lang][1], totals]), len(distinct)).astype(np.int64)
                points = np.stack([distinct >> 21 * k & (1 << 21) - 1 for k in range(NGRAM - 1, -1, -1)], 1)
            held[lang] = points, totals
            if len(points) > HELD_GRAMS:
                bundle(lang)

        for batch in groups(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            codes, owner, alphabet = ngram_codes(_texts(batch))
            distinct, place = distinct_codes(codes, alphabet)
            points = np.stack([alphabet[distinct // len(alphabet) ** k % len(alphabet)] for k in range(NGRAM - 1, -1, -1)], 1)
            for lang in sorted(set(langs)):
                totals = np.bincount(place[(langs == lang)[owner]], minlength=len(distinct))
                hold(lang, points[totals > 0], totals[totals > 0])
            while len(held) > 24:  # bounds memory where languages are many
                bundle(next(iter(held)))
        for lang in list(held):
            bundle(lang)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "vector": pa.array([np.rint(vector).astype(np.int64)], pa.list_(pa.int64()))})

    learn = (common.fold("doc_id", MODULUS) != HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    parts = docs.where(learn).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(common.tidy(run), "lang string, vector array<bigint>")
    places = parts.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = places.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("vector"))
    found = sorted((r["lang"], r["vector"]) for r in rows.collect())  # a row a language
    return LanguageProfiles([lang for lang, _ in found], np.array([v for _, v in found], np.float64).reshape(len(found), dimensions))


def predict(texts: list[str], profiles: LanguageProfiles, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """The nearest language's number (that of languages where there is no letter) and its cosine."""
    codes, counts, alphabet = group_counts(texts)
    best, score = np.full(len(texts), len(profiles.languages)), np.zeros(len(texts))
    known = counts.sum(1) > 0
    if len(profiles.languages) and known.any():
        cosines = profiles.cosines(counts[known] @ bound(codes, alphabet, dimensions).astype(np.float32))
        best[known], score[known] = cosines.argmax(1), np.clip(cosines.max(1), 0, 1)
    return best, score


def identify(docs: DataFrame, profiles: LanguageProfiles, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and the cosine as score (0 where it is negative)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*profiles.languages, UNDETERMINED], object)
        for batch in groups(batches):
            best, score = predict(_texts(batch), profiles, dimensions)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(names[best], pa.string()), "score": score}
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (common.fold("doc_id", MODULUS) == HELD).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(common.tidy(run), SCHEMA)


def identified_documents(docs: DataFrame) -> DataFrame:
    """Contract of op8."""
    return identify(docs, train(docs))


def keep_identified(docs: DataFrame, profiles: LanguageProfiles, dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` without the rows whose language is undetermined: one pass over whole rows, no join."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            best = predict(_texts(batch), profiles, dimensions)[0]
            yield batch.filter(pa.array(best < len(profiles.languages)))

    return docs.mapInArrow(common.tidy(run), schema)
