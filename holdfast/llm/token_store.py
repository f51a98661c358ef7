"""Token ids in a compact binary file format.

Ids are coded with one canonical Huffman code, built from the counts of all ids and limited in length so that a
single table decodes it.  Documents lie in ascending id order in independent blocks.  A block holds its documents' ids
and lengths, the coded bits, and the bit offset of every ``STRIDE``-th token, so that decoding can start at any of them.

Layout of a store (a folder):

``blocks/``    Parquet rows, one a block: shard, block, start (ids before it in the store), doc_ids, lengths,
               n_tokens, offsets (bit offsets, int64), payload (bits, most significant first)
``codebook/``  one row: symbols (ascending), code lengths, table width

Null texts count as empty; null doc_ids come first; equal doc_ids follow each other by text; an empty table gives an
empty store; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Most tokens of a block (a longer document has a block of its own), and tokens between two bit offsets.
BLOCK, STRIDE = 1 << 18, 128
#: Most text bytes that are encoded together, and words whose ids are gathered together (an id's index takes 8 bytes, three times).
ENCODE_BYTES, GATHER_WORDS = 4 << 20, 1 << 15
#: Least width of the decoding table in bits; the widest that a 32-bit window at any bit offset can serve.
WIDTH, MAX_WIDTH = 20, 24
VOCABULARY = "word_bpe_49k.json"

BLOCK_SCHEMA = "shard int, block int, first bigint, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, ids binary"
STORE_SCHEMA = (
    "shard int, block int, start bigint, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint,"
    " offsets binary, payload binary"
)
DOCUMENT_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


# ---------------------------------------------------------------- tokenizing

#: Texts that may be cut between letters and other characters before they are split at white space: ASCII and Latin-1,
#: without the pre-tokenizer's contractions and without special tokens.
_UNSAFE_TEXT = "[^\\x09-\\x0D -~À-ÖØ-öø-ÿß]|'(?i:s|t|re|ve|m|ll|d)|<\\|"
_NO_LETTERS = "([^\\x09-\\x0D a-zß-öø-ÿ]+)"
#: What the pre-tokenizer keeps in one piece, whatever stands beside it.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Entries of a worker's cache before it starts anew.
_CACHE_LIMIT = 1_000_000


class WordTokenizer:
    """The public tokenizer applied to distinct words.

    Its pre-tokenizer drops white space and never joins characters across it, so a text's ids are those of its words in
    turn.  Most texts are first lower-cased and cut between letters and other characters, where the pre-tokenizer cuts
    too, so that fewer distinct words remain.  Runs of letters are encoded many in one call: each ends at a token that
    ends a word.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts, self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        runs = [w for w in words if w.isalpha() and w.islower() or not w.isascii() and _LETTERS.fullmatch(w.decode())]
        others = set(words).difference(runs)
        ids, sizes, names = [], [], []
        for i in range(0, len(runs), 2000):
            part = runs[i : i + 2000]
            found = self._whole(b" ".join(part).decode())
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(part) and stops[-1] == len(found):
                ids.append(found)
                sizes.append(np.diff(stops, prepend=0))
                names += part
            else:
                others.update(part)
        for word in sorted(others):
            ids.append(self._whole(word.decode()))
            sizes.append(np.array([len(ids[-1])]))
            names.append(word)
        sizes = np.concatenate(sizes)
        self.place.update(zip(names, range(len(self.sizes), len(self.sizes) + len(names)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, *ids])

    def encode(self, column: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number in each."""
        texts = pc.fill_null(column.cast(pa.string()), "")
        cut = pc.replace_substring_regex(pc.utf8_lower(texts), _NO_LETTERS, r" \1 ")
        flat, counts = common.words_of(pc.if_else(pc.match_substring_regex(texts, _UNSAFE_TEXT), texts, cut), lower=False)
        coded = flat.cast(pa.binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > _CACHE_LIMIT:
            self._clear()
        if missing := [w for w in distinct if w not in self.place]:
            self._learn(missing)
        places = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy(zero_copy_only=False)]
        each = self.sizes[places]
        word_ends = np.concatenate([[0], np.cumsum(each)])
        ids = np.empty(word_ends[-1], np.uint32)
        for i in range(0, len(places), GATHER_WORDS):
            own = slice(i, i + GATHER_WORDS)
            ids[word_ends[i] : word_ends[min(own.stop, len(places))]] = self.pool[common.ragged(self.starts[places[own]], each[own])]
        doc_ends = word_ends[np.cumsum(counts)]
        if end_id is None:
            return ids, np.diff(doc_ends, prepend=0)
        ids = np.insert(ids, doc_ends, end_id)
        return ids, np.diff(doc_ends, prepend=0) + 1


_TOKENIZERS: dict[str | None, WordTokenizer] = {}
common.KEPT.append(_TOKENIZERS)


def worker_tokenizer(path: str | None) -> WordTokenizer:
    """One for each Python worker, which drops what other operators keep there.

    A task's function has a copy of this module's dictionaries; only functions of the module know the worker's own.
    """
    common.drop_kept(_TOKENIZERS)
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _narrow(ids: np.ndarray) -> bytes:
    """A byte that names the width, then the ids."""
    kind = "<u2" if not len(ids) or int(ids.max()) < 1 << 16 else "<u4"
    return kind[-1].encode() + ids.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[:1].decode()}", offset=1)


def token_blocks(docs: DataFrame, path: str | None = None, end_id: int | None = 2, order: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Documents (doc_id, text) as blocks of ids, in the order of these columns over shards, blocks and within blocks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        tokenizer = worker_tokenizer(path)
        schema = pa.schema(
            [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        count = first = 0

        def flush():
            nonlocal held, count, block, first
            ids = np.concatenate([h[2] for h in held])
            row = pa.RecordBatch.from_pydict(
                {"shard": [shard], "block": [block], "first": [first], "doc_ids": [[i for h in held for i in h[0]]], "lengths": [np.concatenate([h[1] for h in held])], "n_tokens": [len(ids)], "ids": [_narrow(ids)]},
                schema=schema,
            )
            held, count, block, first = [], 0, block + 1, first + len(ids)
            return row

        for batch in common.slices(batches, limit=ENCODE_BYTES):
            ids, lengths = tokenizer.encode(batch.column("text"), end_id)
            doc_ids, ends, start = batch.column("doc_id").to_pylist(), np.cumsum(lengths), 0
            while start < len(ends):
                before = int(ends[start - 1]) if start else 0
                stop = int(np.searchsorted(ends, before + BLOCK - count, side="right"))
                if stop == start and count:
                    yield flush()
                    continue
                stop = max(stop, start + 1)
                after = int(ends[stop - 1])
                held.append((doc_ids[start:stop], lengths[start:stop], ids[before:after]))
                count, start = count + after - before, stop
                if count >= BLOCK:
                    yield flush()
            del batch, ids
            pa.default_memory_pool().release_unused()
        if held:
            yield flush()

    keys = [F.col(f"`{c}`").alias(f"order{i}") for i, c in enumerate(order)]
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *keys)
    names = [f"order{i}" for i in range(len(order))]
    # of texts the first letters are enough for ranges, so that rows without an id spread, too
    ranges = [F.substring(n, 1, 32) if c == "text" else F.col(n) for n, c in zip(names, order, strict=True)]
    ordered = ordered.repartitionByRange(*ranges).sortWithinPartitions(*names).select("doc_id", "text")
    return ordered.mapInArrow(common.tidy(encode), BLOCK_SCHEMA)


# ---------------------------------------------------------------- the code


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code for positive counts, none over ``limit``, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    # from the longest length up: symbols, and pairs of what the length below has
    merged, leaves = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = merged[0 : len(merged) - len(merged) % 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        by = np.argsort(both, kind="stable")
        merged = both[by]
        leaves.append(by < n)
    # the cheapest 2n - 2 of the last; its pairs are twice as many of the length below
    depth, take = np.zeros(n, np.int64), 2 * n - 2
    for own in reversed(leaves):
        used = int(own[:take].sum())
        depth[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = depth
    return out


class CanonicalCode:
    """Codes in order of length and symbol; tables for encoding and for decoding ``width`` bits at a time."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, width: int):
        self.symbols, self.lengths, self.width = symbols.astype(np.int64), lengths.astype(np.int64), width
        order = np.lexsort((self.symbols, self.lengths))
        spans = 1 << (width - self.lengths[order])
        firsts = np.cumsum(spans) - spans
        top = int(self.symbols.max()) + 1 if len(symbols) else 0
        self.code_of = np.zeros(top, np.uint64)
        self.length_of = np.zeros(top, np.int64)
        self.code_of[self.symbols[order]] = (firsts >> (width - self.lengths[order])).astype(np.uint64)
        self.length_of[self.symbols[order]] = self.lengths[order]
        self.symbol_at = np.zeros(1 << width, np.uint32)
        self.length_at = np.ones(1 << width, np.uint8)
        used = int(spans.sum())
        self.symbol_at[:used] = np.repeat(self.symbols[order], spans)
        self.length_at[:used] = np.repeat(self.lengths[order].astype(np.uint8), spans)

    @classmethod
    def from_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> CanonicalCode:
        width = max(WIDTH, int(len(symbols)).bit_length())
        if width > MAX_WIDTH:
            raise ValueError(f"{len(symbols)} distinct ids; at most {1 << (MAX_WIDTH - 1)} can be coded")
        order = np.argsort(symbols)
        return cls(symbols[order], code_lengths(counts[order], width), width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, and the bit offset of every STRIDE-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        lengths = self.length_of[ids]
        if not lengths.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(lengths)
        starts = ends - lengths
        words = np.zeros(int(ends[-1] + 63 >> 6) + 1, np.uint64)
        slot, room = starts >> 6, 64 - (starts & 63) - lengths
        codes = self.code_of[ids]
        inside = np.where(room >= 0, codes << np.maximum(room, 0).astype(np.uint64), codes >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        words[slot[first]] = np.bitwise_or.reduceat(inside, first)
        over = np.flatnonzero(room < 0)  # at most one code crosses from a word to the next
        words[slot[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[: int(ends[-1] + 7 >> 3)], starts[::STRIDE]

    def decode(self, payload: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """All lanes between bit offsets are read at once, a token of each at a step."""
        if not n:
            return np.zeros(0, np.uint32)
        data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at, out = offsets.astype(np.int64), np.empty((STRIDE, len(offsets)), np.uint32)
        shift, mask, last = 32 - self.width, (1 << self.width) - 1, len(window) - 1
        for step in range(STRIDE):
            key = window[np.minimum(at >> 3, last)] >> (shift - (at & 7)).astype(np.uint32) & mask
            out[step] = self.symbol_at[key]
            at += self.length_at[key]
        return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- the store


def write_store(blocks: DataFrame, path: str) -> None:
    """Count all ids, build the code, and write blocks and codebook.  ``blocks``: a written table of BLOCK_SCHEMA."""
    spark = blocks.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        totals = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                new = np.bincount(_wide(data.as_py()))
                if len(new) > len(totals):
                    new, totals = totals, new
                totals[: len(new)] += new
        ids = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"id": ids, "n": totals[ids]})

    counts = blocks.select("ids").mapInArrow(common.tidy(count), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    if counts.limit((1 << (MAX_WIDTH - 1)) + 1).count() > 1 << (MAX_WIDTH - 1):  # the codebook's proven bound
        raise ValueError("too many distinct ids for one code")
    counted = counts.toPandas()
    code = CanonicalCode.from_counts(counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64))
    # One row a writing task: their number is that of partitions.
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, total = {}, 0
    for row in shards:
        before[row["shard"]], total = total, total + row["n"]
    symbols, lengths, width = code.symbols, code.lengths, code.width
    spark.createDataFrame(
        [(symbols.astype("<u4").tobytes(), lengths.astype(np.uint8).tobytes(), width)], "symbols binary, lengths binary, width int"
    ).coalesce(1).write.parquet(f"{path}/codebook")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        coder = CanonicalCode(symbols, lengths, width)
        for batch in batches:
            for i in range(batch.num_rows):
                payload, offsets = coder.encode(_wide(batch.column("ids")[i].as_py()))
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [row.column("shard"), row.column("block"), pa.array([row.column("first")[0].as_py() + before[row.column("shard")[0].as_py()]]), row.column("doc_ids"), row.column("lengths"), row.column("n_tokens"), pa.array([offsets.astype("<i8").tobytes()]), pa.array([payload], pa.binary())],
                    names=["shard", "block", "start", "doc_ids", "lengths", "n_tokens", "offsets", "payload"],
                )

    blocks.mapInArrow(common.tidy(encode), STORE_SCHEMA).write.parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, in store order within each block: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    book = spark.read.parquet(f"{path}/codebook").first()
    symbols, lengths, width = np.frombuffer(book["symbols"], "<u4"), np.frombuffer(book["lengths"], np.uint8), book["width"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        code = CanonicalCode(symbols, lengths, width)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = code.decode(row["payload"], np.frombuffer(row["offsets"], "<i8"), row["n_tokens"]).astype("<u4").tobytes()
                sizes = np.array(row["lengths"], np.int64)
                ends = np.cumsum(sizes)
                texts = [ids[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes), pa.array(sizes), pa.array(texts, pa.binary())], schema=schema)

    return spark.read.parquet(f"{path}/blocks").mapInArrow(common.tidy(decode), DOCUMENT_SCHEMA)


def store_documents(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None, end_id: int | None = 2, order: tuple[str, ...] = ("doc_id", "text")) -> str:
    """Tokenize ``docs`` and write a store in the order of these columns; returns its folder."""
    spark = docs.sparkSession
    path = path or common.new_path(spark, "tokens")
    staged = f"{path}/staged"
    write_store(common.materialize(token_blocks(docs, tokenizer_path, end_id, order), "ids", staged), path)
    common.remove(spark, staged)
    return path


def token_digests(docs: DataFrame, order: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Contract of op7: write, read back, and sum up each document's ids."""
    stored = read_store(docs.sparkSession, store_documents(docs, order=order))
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
