"""Benchmark decontamination with an FM-index of each training shard.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.  A shard is a batch of documents; its text is the sequence
of all its word ids, an end of its own after each document.  The index is its Burrows-Wheeler transform in a wavelet matrix (ranks
of packed bits) with a sample of suffix positions; it does not depend on the benchmark.  Windows of benchmark items whose words
the shard has are searched backwards, all at once; occurrences are walked to the nearest sampled position; the words they cover
are merged to spans.

The benchmark is read in blocks of bounded size.  With one block each shard is indexed and searched in one pass.  With more, the
indexes are written, each block is searched in all of them, and a document's spans are merged over blocks.  A very long text is
cut into parts that overlap by a window, so that an index has SHARD_WORDS words at most.

Null or empty texts have no words and are clean; a null item_id is no item's name, so its windows are hit but it is
counted nowhere; equal item_ids are one item; documents with equal doc_ids are separate rows; an empty benchmark leaves
all documents clean; an empty table gives an empty result; ``mark`` ignores other columns and ``keep_clean`` and
``clean_texts`` keep them.
"""

from __future__ import annotations

import itertools
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Contaminated: at least one part in HIT_PART of the words is hit.
HIT_PART = 20
#: Every so many text positions one is kept for locating.
SAMPLE_RATE = 8
#: Bytes of benchmark text in a block, words in an index.
BLOCK_BYTES, SHARD_WORDS = 8 << 20, 1 << 21
#: Most bytes of texts in a shard (a longer text goes alone): an index and what it is made from take some forty times as much.
SHARD_BYTES = 4 << 20

_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

SCHEMA = "doc_id bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def tokenize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word ids of all texts one after another, the number of each text's words, and the words by their ids."""
    flat, counts = common.words_of(pa.array([t.translate(_TABLE) for t in texts], pa.binary()), lower=False)
    coded = flat.cast(pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), counts, coded.dictionary


class Phrases:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WINDOW):
        ids, counts, self.words = tokenize([text for _, text in items])
        per = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
        owner = np.repeat(np.arange(len(items)), per)
        first = common.ragged(np.cumsum(counts) - counts, per)
        lengths = np.minimum(counts[owner], width)
        self.matrix = np.full((len(owner), width), -1, np.int32)
        for k in range(width):
            has = lengths > k
            self.matrix[has, k] = ids[first[has] + k]
        if len(owner):
            self.matrix, place = np.unique(self.matrix, axis=0, return_inverse=True)
            place = place.ravel()
        else:
            place = owner
        self.lengths = (self.matrix >= 0).sum(1)
        named = np.array([name is not None for name, _ in items], bool)
        by = np.argsort(place, kind="stable")
        by = by[named[owner[by]]] if len(by) else by
        cuts = np.searchsorted(place[by], np.arange(len(self.matrix) + 1))
        self.names = [sorted({items[i][0] for i in owner[by[s:e]].tolist()}) for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def within(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, ids and lengths of the windows all of whose words are among a shard's."""
        found = pc.index_in(self.words, value_set=words)
        ids = np.append(pc.fill_null(found, -1).to_numpy(zero_copy_only=False), -1)[self.matrix]
        live = np.flatnonzero(((ids >= 0) | (self.matrix < 0)).all(1))
        return live, ids[live].astype(np.int64), self.lengths[live]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; only suffixes that are still tied are sorted again.  A symbol of each position's own ends a tie."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)  # the number of smaller suffixes
    ordered = text[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(heads, append=n)
    rank[order] = np.repeat(heads, sizes)
    live, step = order[np.repeat(sizes > 1, sizes)], 1
    while len(live):
        after = live + step
        key = rank[live] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        live, key = live[by], key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        heads = np.flatnonzero(fresh)
        sizes = np.diff(heads, append=len(live))
        old = rank[live]
        group = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        offset = np.repeat(heads, sizes) - np.repeat(group, np.diff(group, append=len(live)))
        rank[live] = old + offset
        live = live[np.repeat(sizes > 1, sizes)]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Symbol access and rank over a sequence, one level for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bits = (sequence >> level & 1).astype(np.uint8)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is before each position."""
        start, end = np.zeros_like(at), at
        for i, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = symbol >> (self.depth - 1 - i) & 1 == 1
            ones_start, ones_end = bits.rank(start), bits.rank(end)
            start = np.where(one, zeros + ones_start, start - ones_start)
            end = np.where(one, zeros + ones_end, end - ones_end)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            bit, ones = bits.get(at), bits.rank(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int):
        """text: symbols below ``alphabet``; an end symbol smaller than all others is added."""
        text = np.concatenate([text + 1, [0]])
        suffixes = suffix_array(text)
        self.n = len(text)
        self.tree = WaveletMatrix(text[suffixes - 1].astype(np.int32), alphabet + 1)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet + 1))])
        sampled = suffixes % SAMPLE_RATE == 0
        self.marked = Bits(sampled.astype(np.uint8))
        self.samples = suffixes[sampled].astype(np.int32)

    def _back(self, row: np.ndarray) -> np.ndarray:
        symbol = self.tree.access(row)
        return self.smaller[symbol] + self.tree.rank(symbol, row)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [first, end) of the suffixes that begin with each pattern."""
        first, end = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (first < end))
            symbol = patterns[live, lengths[live] - back] + 1
            first[live] = self.smaller[symbol] + self.tree.rank(symbol, first[live])
            end[live] = self.smaller[symbol] + self.tree.rank(symbol, end[live])
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_, rows = np.arange(len(rows)), rows.copy()
        while len(open_):
            here = rows[open_]
            done = self.marked.get(here) == 1
            ended = open_[done]
            out[ended] = self.samples[self.marked.rank(rows[ended])] + steps[ended]
            open_ = open_[~done]
            rows[open_] = self._back(rows[open_])
            steps[open_] += 1
        return out


class Shard:
    """The index of a batch of texts, cut into parts where a text is too long."""

    def __init__(self, texts: list[bytes], overlap: int = WINDOW - 1, most: int = SHARD_WORDS):
        ids, self.n_words, self.words = tokenize(texts)
        ends = np.cumsum(self.n_words)
        # (document, its first word in the part, first and end word among all)
        pieces, size = [[]], 0
        for doc, (start, end) in enumerate(zip((ends - self.n_words).tolist(), ends.tolist(), strict=True)):
            for at in range(start, max(end, start + 1), most - overlap):
                stop = min(end, at + most)
                if at > start and stop - at <= overlap:
                    break  # the part before has it
                if size and size + stop - at > most:
                    pieces.append([])
                    size = 0
                pieces[-1].append((doc, at - start, at, stop))
                size += stop - at + 1
        self.parts = []
        for own in pieces:
            docs, firsts, starts, stops = (np.array(x, np.int64) for x in zip(*own, strict=True)) if own else (np.zeros(0, np.int64),) * 4
            sizes = stops - starts
            place = np.cumsum(sizes + 1) - (sizes + 1)
            text = np.empty(int((sizes + 1).sum()), np.int64)
            # ends are symbols of their own, so that equal documents are told apart where they end
            text[place + sizes] = len(self.words) + np.arange(len(own))
            text[common.ragged(place, sizes)] = ids[common.ragged(starts, sizes)]
            self.parts.append((docs, firsts, place, FMIndex(text, len(self.words) + len(own)) if len(text) else None))

    def find(self, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Occurrences: document, first word, window."""
        live, patterns, lengths = phrases.within(self.words)
        if not len(live):
            return
        for docs, firsts, place, index in self.parts:
            if index is None:
                continue
            first, end = index.search(patterns, lengths)
            counts = end - first
            found = np.flatnonzero(counts)
            for i in range(0, len(found), 4096):
                part = found[i : i + 4096]
                rows, window = common.ragged(first[part], counts[part]), np.repeat(part, counts[part])
                for k in range(0, len(rows), 1 << 18):
                    at = index.locate(rows[k : k + (1 << 18)])
                    owner = np.searchsorted(place, at, side="right") - 1
                    yield docs[owner], firsts[owner] + at - place[owner], live[window[k : k + (1 << 18)]]

    def search(self, phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """Number of words, hit spans and items of each text."""
        n = len(self.n_words)
        hits: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
        items: list[set[str]] = [set() for _ in range(n)]
        for owner, first, windows in self.find(phrases):
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order])) + 1
            for group in np.split(order, cuts):
                doc = int(owner[group[0]])
                hits[doc].append((first[group], first[group] + phrases.lengths[windows[group]]))
                for w in np.unique(windows[group]).tolist():
                    items[doc].update(phrases.names[w])
        spans = [merge(np.concatenate([h[0] for h in own]), np.concatenate([h[1] for h in own])) if own else [] for own in hits]
        return self.n_words.tolist(), spans, [sorted(i) for i in items]


def merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans [first, last) from overlapping or touching ones."""
    order = np.argsort(starts, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def search_shard(phrases: Phrases, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """Number of words, hit spans and items of each text."""
    return Shard(texts).search(phrases)


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard each; what a shard took goes before the next."""
    common.drop_kept(_MADE)
    for batch in common.slices(batches, limit=SHARD_BYTES):
        yield batch
        pa.default_memory_pool().release_unused()


#: Phrases that this worker process has made, the last two.
_MADE: dict[str, Phrases] = {}
common.KEPT.append(_MADE)


def phrases_of(items: list[tuple[str | None, bytes]], name: str) -> Phrases:
    """Made once in a worker process, not in each of its tasks."""
    if name not in _MADE:
        while len(_MADE) > 1:
            _MADE.pop(next(iter(_MADE)))
        _MADE[name] = Phrases(items)
    return _MADE[name]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items, in blocks that the driver holds one at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").toLocalIterator():
        block.append((row["item_id"], row["text"].encode()))
        size += len(block[-1][1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _found(n_words: list[int], spans: list[list[tuple[int, int]]], items: list[list[str]]) -> list[pa.Array]:
    listed = [[{"first": a, "last": b} for a, b in own] for own in spans]
    return [pa.array(n_words, pa.int64()), pa.array(listed, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))]


def mark(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's number of words, hit spans (word numbers, the last not included) and items with a window in it."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = benchmark_blocks(benchmark, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = phrases_of(first, name)
            for batch in shards_of(batches):
                found = Shard(common.text_bytes(batch.column("text"))).search(phrases)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_found(*found)], names=_ARROW.names)

        return rows.mapInArrow(common.tidy(run), SCHEMA)
    # rows are told apart by their place, so that equal ids stay separate
    keyed = common.materialize(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards_of(batches):
            shard = pickle.dumps(Shard(common.text_bytes(batch.column("text"))), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("row").to_pylist()], pa.list_(pa.int64())), pa.array([shard], pa.binary())], names=["rows", "shard"])

    shards = common.materialize(keyed.mapInArrow(common.tidy(build), "rows array<bigint>, shard binary"), "indexes")

    def searched(items: list[tuple[str | None, bytes]]) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = phrases_of(items, name)
            for batch in batches:
                for i in range(batch.num_rows):
                    found = pickle.loads(batch.column("shard")[i].as_py()).search(phrases)
                    yield pa.RecordBatch.from_arrays([batch.column("rows")[i].values, *_found(*found)], names=["row", *_ARROW.names[1:]])

        return shards.mapInArrow(common.tidy(run), SCHEMA.replace("doc_id", "row"))

    parts = [searched(items) for items in itertools.chain([first, second], blocks)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    joined = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    # sorted spans of different blocks may overlap
    touching = lambda acc, s: (F.size(acc) > 0) & (s["first"] <= F.try_element_at(acc, F.lit(-1))["last"])
    span_type = "array<struct<first:bigint,last:bigint>>"
    merged = F.aggregate(
        "spans",
        F.array().cast(span_type),
        lambda acc, s: F.when(
            touching(acc, s),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["first"].alias("first"), F.greatest(F.try_element_at(acc, F.lit(-1))["last"], s["last"]).alias("last")))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    return keyed.select("row", "doc_id").join(joined, "row").select("doc_id", "n_words", merged.alias("spans"), "items")


def verdicts(marks: DataFrame, hit_part: int = HIT_PART) -> DataFrame:
    """The contract's digest of ``mark``'s rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["last"] - s["first"])
    rows = marks.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "spans")
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (hit_part * F.col("n_hit") >= F.col("n_words"))).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of op1."""
    return verdicts(mark(docs, benchmark))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    data = np.frombuffer(b" " + text.translate(_TABLE) + b" ", np.uint8) != 32
    edges = np.flatnonzero(np.diff(data.view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : starts[first]])
        at = int(ends[last - 1])
    return b"".join(out) + text[at:]


def clean_texts(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the hit spans cut out of their texts, after they are merged over all blocks of benchmark items."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    keyed = common.materialize(docs.select(F.monotonically_increasing_id().alias("row"), whole), "decontaminate")
    marks = mark(keyed.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), benchmark, block_bytes)
    hit = marks.where(F.size("spans") > 0).select(F.col("doc_id").alias("row"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            cut = [t if not s else cut_spans(t.encode(), [(x["first"], x["last"]) for x in s]).decode() for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cut, pa.string())], names=["row", "cut"])

    texts = keyed.join(hit, "row").select("row", F.col("doc.text").alias("text"), "spans").mapInArrow(common.tidy(run), "row bigint, cut string")
    joined = keyed.join(texts, "row", "left")
    text = F.coalesce("cut", F.col("doc.text").cast("string")).alias("text")
    return joined.select(*[text if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


DECONTAMINATION_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
item_words AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS width, array_to_string(ws[i:i + 12], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item_words WHERE len(ws) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
places AS (
  SELECT rid, i, width, array_to_string(ws[i:i + width - 1], ' ') AS phrase
  FROM (SELECT rid, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM doc_words, widths WHERE len(ws) >= width)),
hits AS (SELECT rid, i, places.width, item_id FROM places JOIN windows USING (phrase, width)),
covered AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(i, i + width)) AS w FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT rid, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_words LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""


def keep_clean(docs: DataFrame, benchmark: DataFrame, hit_part: int = HIT_PART, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated rows.

    With one block of benchmark items this is one pass over whole rows; with more, marks are joined by row number.
    """
    blocks = benchmark_blocks(benchmark, block_bytes)
    items, more = next(blocks, []), next(blocks, None)
    if more is None:

        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = phrases_of(items, name)
            for batch in shards_of(batches):
                n_words, spans, _ = Shard(common.text_bytes(batch.column("text"))).search(phrases)
                n_hit = np.array([sum(e - s for s, e in own) for own in spans], np.int64)
                yield batch.filter(pa.array((n_hit == 0) | (hit_part * n_hit < np.array(n_words, np.int64))))

        return docs.mapInArrow(common.tidy(run), docs.schema)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    keyed = common.materialize(docs.select(F.monotonically_increasing_id().alias("row"), whole), "decontaminate")
    marks = verdicts(mark(keyed.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), benchmark, block_bytes), hit_part)
    return keyed.join(marks.where("contaminated").select(F.col("doc_id").alias("row")), "row", "left_anti").select("doc.*")
