"""Language-model scores by a hierarchical Pitman-Yor process.

Restaurants form a hierarchy.  Each word of the corpus has a restaurant for what follows it (the ends of texts have one for
their first words); its customers are the corpus's tokens.  The tables of all of these are customers of the one word
restaurant, which they share as parent; its tables are customers of the letter restaurants.  Those have a context each
(the last ``ORDER`` letters of the word so far); a context's tables are customers of the context that is one letter
shorter, which all contexts with that ending share; the empty context draws from a uniform base.

As in the plain base score, all words that training has not seen are one type: its probability in the word restaurant's
base is what the letter restaurants leave for words outside the training vocabulary.

Seating is sampled by sweeps over the whole hierarchy.  Each seats anew the customers of every dish given its
restaurant's present tables and its parent's probability, and passes the sampled tables up as the parent's customers:
from pairs of words to words, from words to letters.  Predictive probabilities are averaged over the sweeps.  Letters are put in ``SYMBOLS`` classes (a-z and 0-9 have their own), which bounds the letter restaurants
whatever the corpus; a letter's probability within its class is its smoothed share.

Documents are cut into shards, a row each, which hold their words and tokens.  Word and pair restaurants are spread over
the shards: a shard knows the corpus's counts of all words and pairs that it has.  It sends a hash of each, with its own
count, to the hash's bucket, and gets back the counts of those that other shards have too, so that what occurs in one
shard alone never comes back.  Random numbers depend on the pair or word alone: every shard that has it seats it alike,
and its owner, the first of them, adds its tables to the sums.  Words are told apart by 64-bit hashes, pairs in their
bucket by 40 bits more.

Tokens: words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, then one end for each text.  Learns from rows whose
crc32(doc_id as text) mod 7 is not 2.

Null texts count as empty (an end alone); a null doc_id is in the training part; repeated rows each count; equal texts
score alike; a very long text is a shard of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODULUS, HELD = 7, 2
SYMBOLS, ORDER = 64, 3
STRENGTH = 1.0
SWEEPS, BURN_IN = 12, 6
#: Sweeps over pairs, words and letters (the letter restaurants make SWEEPS of their own in each).  All are averaged; what
#: they start from, one table for each dish, is not.
WORD_SWEEPS = 2
#: Name of the boundary between texts, as the word before a text's first and as the end.
BOUNDARY = 1
#: Probability of an end in the word restaurant's base.
END_BASE = 1e-3
#: Customers seated one by one; later ones in growing groups.
ONE_BY_ONE = 16
#: Least mean of binomial numbers that are drawn as normal ones.
NORMAL = 25
#: Text bytes of a shard; hashes of a bucket; bytes of a pair's hash beside its bucket.
SHARD_BYTES, BUCKET, PAIR_BYTES = 12 << 20, 1 << 21, 5
LN10 = np.log(10.0)

SHARD_SCHEMA = "shard bigint, words binary, tokens binary, lengths array<int>, held array<boolean>, doc_ids array<bigint>, n_learnt bigint, n_tokens bigint"
SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
#: What a pass over shards writes: hashes with values for a bucket, or numbers to be summed.
SENT = "bucket bigint, kind int, shard bigint, names binary, first binary, second binary, key bigint, n double"
#: What buckets send back: values of some of a shard's hashes, by their place in what it sent.
BACK = "shard bigint, bucket bigint, kind int, places binary, first binary, second binary, key bigint, n double"
WORDS, PAIRS, TABLES = 0, 1, 2


# ---------------------------------------------------------------- seating


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniforms(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on key and step alone, so that any task draws the same."""
    return (_mixed(keys + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)) * 2.0**-53


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, keys: np.ndarray, seed: int) -> np.ndarray:
    """Tables of each dish after all its customers sat down.  mass: (strength + discount * tables) * parent's probability."""
    every = np.minimum(customers, 1).astype(np.float64)
    many = np.flatnonzero(customers > 1)
    every[many] = _seat_many(customers[many], mass[many], discount, keys[many], seed)
    return every


def _seat_many(customers: np.ndarray, mass: np.ndarray, discount: float, keys: np.ndarray, seed: int) -> np.ndarray:
    # dishes with most customers first, up to those that all sit one by one, so that those with more than k are the first ones
    capped = np.minimum(customers, ONE_BY_ONE + 1).astype(np.uint8)
    by = np.argsort(ONE_BY_ONE + 1 - capped, kind="stable")
    more = np.cumsum(np.bincount(capped, minlength=ONE_BY_ONE + 2)[::-1])[::-1]  # dishes with so many customers at least
    customers, mass, keys = customers[by], mass[by], keys[by]
    tables = np.ones(len(by))
    for k in range(1, ONE_BY_ONE):  # customer k + 1
        n = int(more[k + 1])
        if not n:
            break
        # fresh: u < mass / (mass + k - discount * tables)
        others = tables[:n] * -discount
        others += k
        others += mass[:n]
        others *= uniforms(keys[:n], seed * 1000 + k)
        tables[:n] += others < mass[:n]
    k, live = ONE_BY_ONE, np.arange(int(more[ONE_BY_ONE + 1]))
    while len(live := live[customers[live] > k]):
        group = np.minimum(customers[live], k + k // 2) - k
        spread = np.maximum(mass[live] + k - discount * tables[live], 1e-9)
        share = np.minimum(mass[live] * np.log1p(group / spread) / group, 1.0)
        tables[live] += binomials(group, share, keys[live], seed * 1000 + k)
        k += k // 2
    out = np.empty(len(by))
    out[by] = tables
    return out


def binomials(n: np.ndarray, p: np.ndarray, keys: np.ndarray, step: int) -> np.ndarray:
    """Binomial numbers by inversion of the uniforms; by the normal approximation where mean or rest is NORMAL or more."""
    n, u = n.astype(np.float64), uniforms(keys, step)
    flipped = p > 0.5
    q = np.where(flipped, 1 - p, p)
    out = np.zeros(len(n))
    large = np.flatnonzero(n * q >= NORMAL)
    if len(large):
        m, v = n[large] * q[large], uniforms(keys[large], step + (1 << 40))
        normal = np.sqrt(-2 * np.log(1 - u[large])) * np.cos(2 * np.pi * v)
        out[large] = np.clip(np.rint(m + np.sqrt(m * (1 - q[large])) * normal), 0, n[large])
    live = np.flatnonzero(n * q < NORMAL)
    chance = np.exp(n[live] * np.log1p(-q[live]))
    below = chance.copy()
    k = 0
    while len(live):
        more = (u[live] >= below) & (k < n[live]) & (k < 600)
        live, chance, below = live[more], chance[more], below[more]
        chance = chance * (n[live] - k) / (k + 1) * q[live] / (1 - q[live])
        below, k = below + chance, k + 1
        out[live] = k
    return np.where(flipped, n - out, out)


def discount_of(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once + twice else 0.5


class LetterModel:
    """Averaged predictive probabilities of letter classes: a row for each known context, and where each context's is."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, points: dict[int, int]):
        """codes: contexts of ORDER classes and a class, base SYMBOLS; points: training counts of code points."""
        levels = self._gibbs(codes.astype(np.int64), counts.astype(np.int64))
        self.row_of, self.rows = levels
        total, alpha = np.zeros(SYMBOLS), 0.5
        table = class_table()
        self.sizes = np.bincount(table, minlength=SYMBOLS)
        own = np.array(sorted(points), np.int64)
        n = np.array([points[p] for p in own.tolist()], np.float64)
        np.add.at(total, table[own], n)
        self.own, share = own, (n + alpha) / (total[table[own]] + alpha * self.sizes[table[own]])
        self.log_share = np.log(share)
        self.log_rest = np.log(alpha / (total + alpha * np.maximum(self.sizes, 1)))

    @staticmethod
    def _gibbs(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = SYMBOLS
        keys, customers, tables = [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1)
        keys[ORDER], customers[ORDER] = codes, counts.astype(np.float64)
        up: list[np.ndarray] = [np.zeros(0, np.int64)] * (ORDER + 1)
        for level in range(ORDER, 0, -1):  # the parent's dish: the context without its first letter
            keys[level - 1], up[level] = np.unique(keys[level] % width**level, return_inverse=True)
            tables[level] = np.minimum(customers[level], 1)
            customers[level - 1] = np.bincount(up[level], tables[level], len(keys[level - 1]))
        tables[0] = np.minimum(customers[0], 1)
        discounts = [discount_of(c) for c in customers]
        hashes = [_mixed(k.astype(np.uint64) + np.uint64(level << 40)) for level, k in enumerate(keys)]
        contexts = np.unique(codes // width)
        place = np.full(width**ORDER, -1, np.int64)
        place[contexts] = np.arange(len(contexts))
        total = np.zeros((len(contexts), width))
        shorter = np.zeros((width ** max(ORDER - 1, 0), width))
        samples = 0
        for sweep in range(SWEEPS):
            dense = LetterModel._predict(keys, customers, tables, discounts)
            for level in range(ORDER, -1, -1):
                context, symbol = keys[level] // width, keys[level] % width
                size = width**level
                all_tables = np.bincount(context, tables[level], size)
                parent = dense[level - 1][context % max(width ** (level - 1), 1), symbol] if level else np.full(len(symbol), 1 / width)
                mass = (STRENGTH + discounts[level] * all_tables[context]) * parent
                tables[level] = seat(customers[level], mass, discounts[level], hashes[level], sweep + 1)
                if level:
                    customers[level - 1] = np.bincount(up[level], tables[level], len(keys[level - 1]))
            if sweep >= BURN_IN:
                dense = LetterModel._predict(keys, customers, tables, discounts)
                total += LetterModel._top(keys, customers, tables, discounts, dense, contexts, place)
                shorter += dense[ORDER - 1]
                samples += 1
        # contexts never seen have the row of their ending
        rows = np.vstack([total, shorter]) / samples
        row_of = np.where(place >= 0, place, len(contexts) + np.arange(width**ORDER) % width ** (ORDER - 1))
        return row_of.astype(np.int32), np.log(rows).astype(np.float32)

    @staticmethod
    def _predict(keys, customers, tables, discounts) -> list[np.ndarray]:
        """Dense probabilities of the levels below ORDER."""
        out, parent = [], np.full((1, SYMBOLS), 1 / SYMBOLS)
        for level in range(ORDER):
            size = SYMBOLS**level
            above = parent[np.arange(size) % len(parent)]
            out.append(LetterModel._mix(keys[level] // SYMBOLS, keys[level] % SYMBOLS, customers[level], tables[level], discounts[level], above))
            parent = out[-1]
        return out

    @staticmethod
    def _mix(context, symbol, customers, tables, discount, above) -> np.ndarray:
        n, t = np.bincount(context, customers, len(above)), np.bincount(context, tables, len(above))
        probability = above * ((STRENGTH + discount * t) / (STRENGTH + n))[:, None]
        probability[context, symbol] += (customers - discount * tables) / (STRENGTH + n[context])
        return probability

    @staticmethod
    def _top(keys, customers, tables, discounts, dense, contexts, place) -> np.ndarray:
        above = dense[ORDER - 1][contexts % SYMBOLS ** (ORDER - 1)]
        return LetterModel._mix(place[keys[ORDER] // SYMBOLS], keys[ORDER] % SYMBOLS, customers[ORDER], tables[ORDER], discounts[ORDER], above)

    def log_probability(self, letters: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Natural log of each word's letters and its end, from ``letter_codes``."""
        code, points, ends = letters
        if not len(ends):
            return np.zeros(0)
        value = self.rows.ravel()[self.row_of[code // SYMBOLS] * np.int64(SYMBOLS) + code % SYMBOLS].astype(np.float64)
        value += self._shares()[points]
        return np.add.reduceat(value, np.concatenate([[0], ends[:-1] + 1]))

    def _shares(self) -> np.ndarray:
        """Natural log of each code point's share of its class; 0 for the end of a word, which stands as a line break."""
        out = self.log_rest[class_table()]
        out[self.own] = self.log_share
        out[ord("\n")] = 0
        return out


_CLASSES: np.ndarray | None = None


def class_table() -> np.ndarray:
    """Class of each code point: 0 is the end of a word, 1-26 a-z, 27-36 digits, the rest by code point."""
    global _CLASSES
    if _CLASSES is None:
        points = np.arange(0x110000, dtype=np.int64)
        _CLASSES = (37 + points * 40503 % 65521 % (SYMBOLS - 37)).astype(np.int32)
        _CLASSES[ord("a") : ord("z") + 1] = np.arange(1, 27)
        _CLASSES[ord("0") : ord("9") + 1] = np.arange(27, 37)
    return _CLASSES


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter and end of the words: context and class as one number, the code point, and where the ends are."""
    points = np.frombuffer(("\n".join(words) + "\n" if words else "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    symbols = np.where(points == 10, 0, class_table()[points])
    ends = np.flatnonzero(points == 10)
    if not len(ends):
        return np.zeros(0, np.int32), points, ends
    starts = np.concatenate([[0], ends[:-1] + 1])
    at = np.arange(len(points)) - np.repeat(starts, ends - starts + 1)
    code = np.zeros(len(points), np.int32)
    for back in range(ORDER, 0, -1):
        before = np.zeros(len(points), np.int32)
        before[back:] = symbols[:-back]
        code = code * SYMBOLS + np.where(at >= back, before, 0)
    return code * SYMBOLS + symbols, points, ends


# ---------------------------------------------------------------- letters of words


def letter_keys(letters: tuple[np.ndarray, np.ndarray, np.ndarray], tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the letter restaurants learn from words, a customer for each table (0 leaves a word out): counts of contexts with a
    letter, and of code points (as negative keys).  Their number is bounded whatever the words."""
    code, points, ends = letters
    if not len(ends):
        return np.zeros(0, np.int64), np.zeros(0)
    weight = np.repeat(tables.astype(np.float32), np.diff(ends, prepend=-1))
    place, found = pd.factorize(code)
    counts = np.bincount(place, weight, len(found))
    weight[ends] = 0
    of_points = np.bincount(points, weight)
    own = np.flatnonzero(of_points)
    return np.concatenate([found[counts > 0].astype(np.int64), -1 - own]), np.concatenate([counts[counts > 0], of_points[own]])


def letter_model(keys: np.ndarray, counts: np.ndarray) -> LetterModel:
    by = np.argsort(keys)
    key, n = keys[by], np.rint(counts[by]).astype(np.int64)
    return LetterModel(key[key >= 0], n[key >= 0], dict(zip((-1 - key[key < 0]).tolist(), n[key < 0].tolist(), strict=True)))


# ---------------------------------------------------------------- shards


def word_names(words: list[str]) -> np.ndarray:
    """64-bit names of the words, and last that of the boundary."""
    names = hash_array(np.array(words, object), categorize=False) if words else np.zeros(0, np.uint64)
    for i in [i for i, w in enumerate(words) if "\0" in w] if "\0" in "".join(words) else []:  # that hash ends there
        names[i] = xxhash.xxh64_intdigest(words[i].encode("utf-8", "surrogatepass"))
    return np.append(names, np.uint64(BOUNDARY))


def pair_hashes(before: np.ndarray, names: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of words from those of the words."""
    with np.errstate(over="ignore"):
        before *= np.uint64(0x9E3779B97F4A7C15)
        before += names
    return _mixed(before)


def sorting(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of 64-bit hashes in ascending order, and the hashes in it: their upper bits are sorted with the place in the lower
    ones, and the few that share their upper bits without being equal are put in order after that."""
    width = np.uint64(max(len(hashes), 1).bit_length())
    both = hashes >> width
    both <<= width
    both |= np.arange(len(hashes), dtype=np.uint64)
    both.sort()
    by = (both & (np.uint64(1) << width) - np.uint64(1)).astype(np.int32 if width < 32 else np.int64)
    ordered = hashes[by]
    falls = np.flatnonzero(ordered[1:] < ordered[:-1])
    if len(falls):
        both >>= width
        for upper in np.unique(both[falls]):
            s, e = np.searchsorted(both, upper), np.searchsorted(both, upper, side="right")
            by[s:e] = by[s:e][np.argsort(hashes[by[s:e]], kind="stable")]
            ordered[s:e] = hashes[by[s:e]]
    return by, ordered


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers, byte by byte of each in turn, compressed."""
    raw = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def shard_texts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """SHARD_SCHEMA rows: a shard's words, its tokens (numbers of its words; their number is the end), and its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def row() -> pa.RecordBatch:
            nonlocal held, size, shard
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            flat, counts = common.words_of(batch.column("text"), lower=True)
            coded = flat.dictionary_encode()
            n = len(coded.dictionary)
            ends = np.cumsum(counts + 1)
            tokens = np.full(int(ends[-1]), n, np.int64)
            tokens[np.delete(np.arange(len(tokens)), ends - 1)] = coded.indices.to_numpy(zero_copy_only=False)
            out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            words = b"\n".join(coded.dictionary.cast(pa.binary()).to_pylist())
            values = [
                [shard], [len(words).to_bytes(8, "little") + pa.compress(words, "zstd", asbytes=True)], [_packed(tokens, "<u4")], [(counts + 1).tolist()], [out.tolist()],
                [batch.column("doc_id").to_pylist()], [int((counts + 1)[~out].sum())], [len(tokens)],
            ]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            names = ["shard", "words", "tokens", "lengths", "held", "doc_ids", "n_learnt", "n_tokens"]
            held, size, shard = [], 0, shard + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in common.slices(batches, limit=min(shard_bytes, common.SLICE_BYTES // 4)):
            own = batch.column("text").nbytes
            if held and size + own > shard_bytes:
                yield row()
            held.append(batch)
            size += own
        if held:
            yield row()

    own = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (common.fold("doc_id", MODULUS) == HELD).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return own.mapInArrow(run, SHARD_SCHEMA)


class Shard:
    """A shard's words and pairs, in the order of their hashes, with the corpus's counts once buckets have sent them."""

    def __init__(self, row: dict, bits: int):
        data = row["words"]
        raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True) if len(data) > 8 else b""
        self.id, self.bits = row["shard"], bits
        self.text = raw.decode("utf-8", "surrogatepass")
        words = self.text.split("\n") if raw else []
        self.tokens = _unpacked(row["tokens"], "<u4").view(np.int32)
        self.lengths, self.held, self.doc_ids = np.array(row["lengths"], np.int64), np.array(row["held"], bool), row["doc_ids"]
        n = len(words)
        self.names = word_names(words)
        learnt = np.repeat(~self.held, self.lengths)
        self.counts = np.bincount(self.tokens[learnt], minlength=n + 1).astype(np.float64)
        before = np.concatenate([np.array([n], np.int32), self.tokens[:-1]])
        hashes = pair_hashes(self.names[before], self.names[self.tokens])
        by, ordered = sorting(hashes)
        fresh = np.empty(len(by), bool)
        fresh[0] = True
        np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
        self.hashes, first = ordered[fresh], by[fresh]
        self.u, self.w = before[first], self.tokens[first]
        self.place = np.empty(len(by), np.int32)
        self.place[by] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
        self.pair_counts = np.bincount(self.place[learnt], minlength=len(first)).astype(np.float32)
        self.by_name = np.argsort(self.names)
        self.own, self.own_pairs = np.ones(n + 1, bool), np.ones(len(first), bool)
        self._letters: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def letters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self._letters is None:
            self._letters = letter_codes([self.text] if self.text else [])
        return self._letters

    def send(self, kind: int, hashes: np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> Iterator[tuple]:
        """SENT rows of sorted hashes with their numbers, a row for each bucket."""
        if not len(hashes):
            return
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        width = PAIR_BYTES if kind == PAIRS else 8
        low = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
        for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(bucket)], strict=True):
            yield int(bucket[s]), kind, self.id, low[s:e].tobytes(), _packed(first[s:e], "<u8"), None if second is None else _packed(second[s:e], "<u8"), None, None

    def take(self, back: list[dict]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Take in what buckets sent back; returns, for each kind of tables, those of each word's restaurant and those at
        which it is the dish."""
        names, out = self.names[self.by_name], {}
        for row in back:
            kind, bucket = row["kind"], np.uint64(row["bucket"] << 64 - self.bits if self.bits else 0)
            start = int(np.searchsorted(self.hashes if kind == PAIRS else names, bucket))
            first = _unpacked(row["first"], "<u8")
            if kind >= TABLES:
                after, before = out.setdefault(kind, (np.zeros(len(names)), np.zeros(len(names))))
                at = self.by_name[start : start + len(first)]
                after[at], before[at] = first, _unpacked(row["second"], "<u8")
                continue
            at, own = start + _unpacked(row["places"], "<u4").astype(np.int64), _unpacked(row["second"], "u1").astype(bool)
            if kind == WORDS:
                self.counts[self.by_name[at]], self.own[self.by_name[at]] = first, own
            else:
                self.pair_counts[at], self.own_pairs[at] = first, own
        return out

    def send_tables(self, sweep: int, tables: np.ndarray) -> Iterator[tuple]:
        """The tables that its own pairs have, summed by the restaurant and by the dish."""
        own, n = tables * self.own_pairs, len(self.names)
        after, before = np.bincount(self.u, own, n), np.bincount(self.w, own, n)
        yield from self.send(TABLES + sweep, self.names[self.by_name], after[self.by_name], before[self.by_name])


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], names=[name for name, _ in fields])


def _joined(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of several rows as numbers, and the number of the row of each."""
    low = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :width] = low
    return out.view("<u8").ravel(), np.repeat(np.arange(len(rows)), [len(r) // width for r in rows])


def _gathered(sent: DataFrame) -> DataFrame:
    """What the buckets send back.

    Of words and pairs: the corpus's counts of those that several shards have, to each of these shards, and which of them
    is the owner; and numbers of distinct ones (all, that occur once, twice) under the keys 3 * kind + 0, 1, 2.  Of tables:
    the sums of all that was sent, in the order in which it was.
    """

    def counted(kind: int, bucket: int, shards: list[int], names: list[bytes], first: list[bytes]) -> Iterator[tuple]:
        keys, row = _joined(names, PAIR_BYTES if kind == PAIRS else 8)
        n = np.concatenate([_unpacked(x, "<u8") for x in first]).astype(np.int64)
        by = np.argsort(keys, kind="stable")  # rows come in the order of shards
        heads = np.flatnonzero(np.concatenate([[True], keys[by][1:] != keys[by][:-1]]))
        sizes, totals = np.diff(heads, append=len(keys)), np.add.reduceat(n[by], heads)
        for k, m in enumerate((np.count_nonzero(totals), np.count_nonzero(totals == 1), np.count_nonzero(totals == 2))):
            yield None, None, None, None, None, None, 3 * kind + k, float(m)
        many = np.repeat(sizes > 1, sizes)
        at, total, owner = by[many], np.repeat(totals, sizes)[many], np.zeros(len(by), bool)
        owner[heads] = True
        order = np.argsort(at)
        at, total, owner = at[order], total[order], owner[many][order]
        starts = np.cumsum([0, *(len(x) // (PAIR_BYTES if kind == PAIRS else 8) for x in names)])
        cuts = np.searchsorted(at, starts)
        for i, shard in enumerate(shards):
            s, e = int(cuts[i]), int(cuts[i + 1])
            if s < e:
                yield shard, bucket, kind, _packed(at[s:e] - starts[i], "<u4"), _packed(total[s:e], "<u8"), _packed(owner[s:e], "u1"), None, None

    def summed(kind: int, bucket: int, shards: list[int], names: list[bytes], first: list[bytes], second: list[bytes]) -> Iterator[tuple]:
        keys, row = _joined(names, 8)
        place = np.unique(keys, return_inverse=True)[1]
        sums = [np.bincount(place, np.concatenate([_unpacked(x, "<u8") for x in own]).astype(np.float64))[place] for own in (first, second)]
        cuts = np.searchsorted(row, np.arange(len(shards) + 1))
        for i, shard in enumerate(shards):
            part = slice(int(cuts[i]), int(cuts[i + 1]))
            yield shard, bucket, kind, None, _packed(sums[0][part], "<u8"), _packed(sums[1][part], "<u8"), None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> Iterator[pa.RecordBatch]:
            columns = [[r[c] for r in held] for c in ("shard", "names", "first", "second")]
            bucket, kind = held[0]["bucket"], held[0]["kind"]
            rows = list(summed(kind, bucket, *columns) if kind >= TABLES else counted(kind, bucket, *columns[:3]))
            yield _rows(rows, BACK)

        for batch in batches:
            for r in batch.to_pylist():
                if held and (held[0]["bucket"], held[0]["kind"]) != (r["bucket"], r["kind"]):
                    yield from done()
                    held.clear()
                held.append(r)
        if held:
            yield from done()

    return sent.where("bucket is not null").repartition("bucket").sortWithinPartitions("bucket", "kind", "shard").mapInArrow(run, BACK)


# ---------------------------------------------------------------- the model


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once + twice else 0.5


@dataclass
class Sweep:
    """What all shards know of a sweep: the letters and sums that it starts from, and the sums that it comes to."""

    number: int
    letters: LetterModel
    pair_discount: float
    discount: float
    #: Tables and customers of the word restaurant before the sweep, and its tables after it.
    tables: float
    customers: float
    seated: float = 0.0
    #: Probability of all words that training has not seen.
    unseen: float = 0.0

    def words(self, shard: Shard, customers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Base probability and tables of each word and the end."""
        bases = np.exp(np.clip(np.append(self.letters.log_probability(shard.letters()) + np.log1p(-END_BASE), np.log(END_BASE)), -700, 0))
        return bases, seat(customers.astype(np.int64), (STRENGTH + self.discount * self.tables) * bases, self.discount, _mixed(shard.names), self.number)

    def chances(self, bases: np.ndarray, customers: np.ndarray, tables: np.ndarray, total: float) -> np.ndarray:
        """Probability of each word in the word restaurant that has ``total`` tables."""
        return (np.maximum(customers - self.discount * tables, 0.0) + (STRENGTH + self.discount * total) * bases) / (STRENGTH + self.customers)

    def pairs(self, shard: Shard, served: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Tables of each pair."""
        tables = np.minimum(shard.pair_counts, 1).astype(np.float64)
        many = np.flatnonzero(shard.pair_counts > 1)
        mass = (STRENGTH + self.pair_discount * served[shard.u[many]]) * chances[shard.w[many]]
        tables[many] = _seat_many(shard.pair_counts[many].astype(np.int64), mass, self.pair_discount, shard.hashes[many], self.number)
        return tables


#: Keys of numbers that passes sum, below those of code points.
_SUMS = -(1 << 40)
Tables = dict[int, tuple[np.ndarray, np.ndarray]]


def _sums(keys: np.ndarray | list[int], values: np.ndarray | list[float]) -> list[tuple]:
    return [(None, None, None, None, None, None, int(k), float(v)) for k, v in zip(keys, values, strict=True)]


def _numbers(rows: DataFrame) -> dict[int, float]:
    """Sums of a bounded number of keys."""
    found = rows.where("key is not null").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    return dict(zip(found["key"].tolist(), found["n"].tolist(), strict=True))


class Restaurants:
    """Seating of all restaurants, by passes over the shards."""

    def __init__(self, shards: DataFrame):
        self.shards = shards
        facts = shards.agg(F.coalesce(F.sum("n_learnt"), F.lit(0)).alias("learnt"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
        self.n, self.bits = facts["learnt"], int(facts["tokens"] // BUCKET).bit_length()
        bits = self.bits

        def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    own = Shard(batch.slice(i, 1).to_pylist()[0], bits)
                    by = own.by_name
                    yield _rows([*own.send(WORDS, own.names[by], own.counts[by]), *own.send(PAIRS, own.hashes, own.pair_counts)], SENT)

        found = common.materialize(_gathered(shards.mapInArrow(counts, SENT)), "counts")
        self.back, facts = found.where("shard is not null"), _numbers(found.select("key", "n"))
        fact = lambda k: facts.get(k, 0.0)
        self.types = fact(3 * WORDS)
        pair_discount = _discount(fact(3 * PAIRS + 1), fact(3 * PAIRS + 2))

        def alone(shard: Shard, _tables: Tables) -> Iterator[tuple]:
            yield from shard.send_tables(0, np.minimum(shard.pair_counts, 1))
            yield from _sums(*letter_keys(shard.letters(), (shard.own & (shard.counts > 0))[:-1].astype(np.float64)))

        sums = self._sweep(alone)
        self.sweeps = [Sweep(1, self._letters(sums), pair_discount, _discount(fact(3 * WORDS + 1), fact(3 * WORDS + 2)), self.types, fact(3 * PAIRS))]
        for number in range(1, WORD_SWEEPS + 1):
            now = self.sweeps[-1]

            def seated(shard: Shard, tables: Tables, now=now) -> Iterator[tuple]:
                after, before = tables[TABLES + now.number - 1]
                bases, own_tables = now.words(shard, before)
                pairs = now.pairs(shard, after, now.chances(bases, before, own_tables, now.tables))
                yield from shard.send_tables(now.number, pairs)
                own = shard.own & (shard.counts > 0)
                at = np.flatnonzero(own[:-1])
                yield from _sums(*letter_keys(shard.letters(), np.where(own, own_tables, 0)[:-1]))
                values = [own_tables[own].sum(), (pairs * shard.own_pairs).sum(), np.count_nonzero(before[own] == 1), np.count_nonzero(before[own] == 2), np.floor(bases[at] * 2.0**52).sum()]
                yield from _sums([_SUMS - k for k in range(len(values))], values)

            sums = self._sweep(seated)
            tables, customers, once, twice, mass = (sums.get(_SUMS - k, 0.0) for k in range(5))
            now.seated = tables
            now.unseen = (STRENGTH + now.discount * tables) / (STRENGTH + now.customers) * float(np.clip(1 - END_BASE - mass / 2.0**52, 1e-6, 1))
            if number < WORD_SWEEPS:
                self.sweeps.append(Sweep(number + 1, self._letters(sums), pair_discount, _discount(once, twice), tables, customers))

    @staticmethod
    def _letters(sums: dict[int, float]) -> LetterModel:
        keys = np.array(sorted(k for k in sums if k > _SUMS), np.int64)
        return letter_model(keys, np.array([sums[k] for k in keys.tolist()]))

    def over(self, step: Callable[[Shard, Tables], pa.RecordBatch], schema: str) -> DataFrame:
        """``step`` of each shard with what the buckets sent it."""
        bits, nothing = self.bits, _rows([], schema)

        def run(_key, rows: pa.Table, back: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return pa.Table.from_batches([nothing])
            shard = Shard(rows.slice(0, 1).to_pylist()[0], bits)
            return pa.Table.from_batches([step(shard, shard.take(back.to_pylist()))])

        return self.shards.groupBy("shard").cogroup(self.back.drop("key", "n").groupBy("shard")).applyInArrow(run, schema)

    def _sweep(self, step: Callable[[Shard, Tables], Iterator[tuple]]) -> dict[int, float]:
        """Run a step that yields SENT rows; adds the sums of tables to what shards are sent, and returns other sums."""
        spark = self.shards.sparkSession
        with common.scratch(spark) as keep:
            sent = common.materialize(self.over(lambda *a: _rows(list(step(*a)), SENT), SENT), "sweep")
            self.back = self.back.union(keep(common.materialize(_gathered(sent), "tables")))
            return _numbers(sent.select("key", "n"))


def score_texts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Contract of op4."""
    with common.scratch(docs.sparkSession) as keep:
        model = Restaurants(common.materialize(shard_texts(docs, shard_bytes), "shards"))
        n, sweeps, bottom = model.n, model.sweeps, np.log10(model.n + model.types + 1)

        def scores(shard: Shard, tables: Tables) -> pa.RecordBatch:
            chance = np.zeros(len(shard.hashes))
            for now in sweeps:
                after, before = tables[TABLES + now.number - 1]
                bases, own_tables = now.words(shard, before)
                pairs = now.pairs(shard, after, now.chances(bases, before, own_tables, now.tables))
                p = np.where(shard.counts > 0, now.chances(bases, before, own_tables, now.seated), now.unseen)
                served, discount = tables[TABLES + now.number][0], now.pair_discount
                new = np.maximum(shard.pair_counts - discount * pairs, 0.0) + (STRENGTH + discount * served[shard.u]) * p[shard.w]
                chance += new / (STRENGTH + shard.counts[shard.u])
            value = np.log10(np.maximum(chance / len(sweeps), 1e-300))[shard.place]
            starts = np.cumsum(shard.lengths) - shard.lengths
            plain = np.log10(shard.counts + 1) - bottom
            sums = lambda x: pa.array(np.add.reduceat(x, starts))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.doc_ids, pa.int64()), pa.array(shard.held), pa.array(shard.lengths), sums((shard.counts > 0)[shard.tokens].astype(np.int64)),
                    pa.array(np.full(len(starts), n), pa.int64()), sums(plain[shard.tokens]), sums(value),
                ],
                names=[c.split(" ")[0] for c in SCHEMA.split(", ")],
            )

        return keep(common.materialize(model.over(scores, SCHEMA), "scores"))
