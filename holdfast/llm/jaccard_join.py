"""Exact Jaccard join of word shingle sets by partition and pigeonhole.

A document's set is its distinct 5-word shingles.  The universe of shingles is cut into segments by hash, more of them
for larger size bands; shingles that many documents share have segments of their own, a class of segments for each power
of two of their number.  Two sets with similarity 0.75 or more differ in at most H = (|R| + |S|) / 7 shingles.  A segment
is used either whole (one key: both sets must be equal in it, or they differ there by one at least) or also with its
one-deletion neighbourhood (a key for each shingle left out: they must be within one of each other, or differ there by
two).  These are its first and second unit; each counts one.  Units are taken in one order for all sets of a band, by
their cost in keys and in candidates, until a set has H + 1 units: then a similar pair shares a key.  (The set whose
units end first has H + 1 of them in common order, so some segment differs by less than its units; the other set takes
the same units of that segment.)  A set that has too few units indexes all its shingles as well.  The counts of shared
shingles only steer cost; every order finds all links.

Equal sets are one node, named by a 64-bit digest; its texts' documents are joined in at the end.  Nodes that share a key
form a group, and groups of equal members are one.  In a group a node's
hub is the least set of its own size or little less.  First each node is compared with the two hubs that it has in most groups;
then, in groups whose members are still in different components, with nodes of the component that has most members there; and
at last, in those that remain, every two members of different components are, so that a group of near copies is not expanded
into its pairs.  Pairs are compared by size, by a parity bitmap (its bits that differ are a lower bound of the difference),
and at last exactly by the shingles of their texts.  Links become components by alternating stars.

A document of fewer than five words has its whole sequence as its one shingle; null texts and texts without words have
the empty set and link with nothing.  Rows with a null doc_id link with nothing and have a null component.  Rows with
equal doc_ids are one document whose links are those of any of its texts.  Very long texts are sets like all others; one
text is held at a time, with eight bytes for each of its words.  An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE = 5
#: Similarity: 100 * |intersection| >= 75 * |union|, so the sizes' ratio is at most 4 / 3 and the difference (|R| + |S|) / 7.
#: Bits of a size by which bands differ: sizes of a band are within a factor of four.
BAND_BITS = 2
#: Segments of a class of a band: this part of its largest size.
SEGMENTS = 0.45
#: A shingle that this many sets of one task share is counted over all tasks ...
LOCAL_HOT = 8
#: ... of the shingles that a task holds counts of ...
TASK_HOT = 100_000
#: ... and has a class of segments by its count; so many, the most frequent, steer the order (it changes no result).
HOT_SHINGLES = 50_000
#: Cost of a member met in a group, in keys; and of a deletion neighbourhood's keys.
MEETING_COST, SECOND_COST = 1 / 16, 2.5
#: Keys that a task gathers before it writes them, and keys of a bucket.
HELD_KEYS, BUCKET_KEYS = 1 << 20, 1 << 19
#: Bytes of a key that are written; the bucket has its upper bits.
KEY_BYTES = 5
#: Members of a group that go into one row, and members of groups with one first member that are compared in one table.
PART, ROUTE = 1024, 2048
#: Bits for a shingle in the bitmaps that choose the last pairs.
WIDE = 8
#: Rounds that link members of a group to its greatest component before all pairs are compared.
ROUNDS = 2
#: Partners of one node that are compared in one task.
PARTNERS = 256
#: Ids of documents in candidate pairs that are broadcast to pick their texts (8 MB), and of those that ``keep_one`` drops; more
#: are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_U = np.uint64
SUMMARY = "doc_id bigint, n_shingles bigint, node bigint, sig binary, wide binary, hot bigint, hot_count bigint"
GROUPS = "gid bigint, members bigint, part int, parts int, nodes array<bigint>, hubs array<bigint>"


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
        return x ^ x >> _U(31)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    flat, counts = common.words_of(column, lower=True)
    coded = flat.cast(pa.binary()).dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))[coded.indices.to_numpy(zero_copy_only=False)]
    out, ends = [], np.cumsum(counts)
    with np.errstate(over="ignore"):
        n = len(hashes) - SHINGLE + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(SHINGLE if n > 0 else 0):
            rolled = mix(rolled * _U(0x9E3779B97F4A7C15) + hashes[k : n + k])
        for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            if end - start >= SHINGLE:
                out.append(np.unique(rolled[start : end - SHINGLE + 1]))
            elif end > start:
                whole = np.array([end - start], np.uint64)
                for h in hashes[start:end]:
                    whole = mix(whole * _U(0xD6E8FEB86659FD93) + h)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def digest(own: np.ndarray) -> int:
    """Name of a set."""
    with np.errstate(over="ignore"):
        return int(mix(mix(own).sum(dtype=np.uint64) + _U(len(own))).view(np.int64))


def parity_bits(own: np.ndarray, bits: int = 1) -> bytes:
    """A bitmap of at least ``bits`` bits for each shingle of the set, a power of two; each shingle flips a bit."""
    size = 64
    while size < bits * len(own):
        size *= 2
    flips = np.bincount((own & _U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def band_of(size: int) -> int:
    return (size.bit_length() - 1) // BAND_BITS


def bands(size: int) -> list[tuple[int, int]]:
    """(band, largest difference) in which a set of this size is indexed: its own, and the one below if that has
    partners."""
    own = band_of(size)
    out = [(own, (size + 4 * size // 3) // 7)]
    top = 2 ** (own * BAND_BITS) - 1
    if 3 * size <= 4 * top:
        out.append((own - 1, (size + top) // 7))
    return out


class Index:
    """Classes of shared shingles, the order of units, and a set's keys."""

    def __init__(self, hot: np.ndarray, counts: np.ndarray):
        by = np.argsort(hot)
        self.hot, self.classes = hot[by], np.log2(np.maximum(counts[by], 2)).astype(np.int64)

    def keys(self, own: np.ndarray) -> np.ndarray:
        out = []
        mixed, of_class = mix(own), np.zeros(len(own), np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, own), len(self.hot) - 1)
            of_class = np.where(self.hot[at] == own, self.classes[at], 0)
        with np.errstate(over="ignore"):
            for band, difference in bands(len(own)):
                need, width = difference + 1, max(1, round(SEGMENTS * 2 ** (BAND_BITS * (band + 1))))
                segment = (mixed % _U(width)).astype(np.int64) + of_class * width
                by = np.argsort(segment, kind="stable")
                placed, weights = segment[by], mix(own[by] + _U(band + 1))
                heads = np.flatnonzero(np.diff(placed, prepend=-1))
                sizes = np.diff(heads, append=len(placed))
                sums = np.add.reduceat(weights, heads)
                keys = mix(sums + placed[heads].astype(np.uint64))
                if need <= len(heads) and not placed[heads[need - 1]] // width:  # first units of the plain class suffice
                    out.append(keys[:need])
                    continue
                shared = placed[heads] // width
                met = np.where(shared > 0, MEETING_COST * 2.0**shared, 0.0)
                twice = np.flatnonzero(sizes > 1)
                cost = np.concatenate([1 + met, SECOND_COST * (1 + met[twice])])
                units = np.argsort(cost, kind="stable")[:need]
                out.append(keys[units[units < len(heads)]])
                for i in twice[units[units >= len(heads)] - len(heads)].tolist():
                    part = weights[heads[i] : heads[i] + sizes[i]]
                    out.append(mix(sums[i] - part + _U(placed[heads[i]])))
                if len(units) < need:
                    out.append(mix(weights ^ _U(0x2545F4914F6CDD1D)))
        return np.unique(np.concatenate(out))


def _most(names: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    if len(names) > most:
        chosen = np.argsort(-counts, kind="stable")[:most]
        return names[chosen], counts[chosen]
    return names, counts


def summarize(docs: DataFrame) -> DataFrame:
    """A row a document with its set's size, name and parity bits; and rows of shingles that are frequent in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("sig", pa.binary()), ("wide", pa.binary()), ("hot", pa.int64()), ("hot_count", pa.int64())])
        hot, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in common.slices(batches):
            sets = shingle_sets(batch.column("text"))
            names = [digest(s) for s in sets]
            found, own = np.unique(np.concatenate(list(dict(zip(names, sets, strict=True)).values())), return_counts=True)
            found, own = found[own > 1], own[own > 1]
            both, place = np.unique(np.concatenate([hot, found]), return_inverse=True)
            hot, counts = _most(both, np.bincount(place, np.concatenate([counts, own]), len(both)).astype(np.int64), TASK_HOT)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array([parity_bits(s) for s in sets], pa.binary()), pa.array([parity_bits(s, WIDE) for s in sets], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                schema=schema,
            )
        often = counts >= LOCAL_HOT
        m = int(often.sum())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(m, schema.field(i).type) for i in range(5)), pa.array(hot[often].view(np.int64)), pa.array(counts[often])], schema=schema)

    return docs.mapInArrow(common.tidy(run), SUMMARY)


def index_keys(docs: DataFrame, index: Index, bits: int) -> DataFrame:
    """(bucket, keys, nodes, sizes, counts): the keys of a task's sets by their first ``bits`` bits; node i has counts[i] of them."""

    def rows(keys: list[np.ndarray], nodes: list[int], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        owner = np.repeat(np.arange(len(nodes)), [len(k) for k in keys])
        every, names, widths = np.concatenate(keys), np.array(nodes, np.int64), np.array(sizes, "<u4")
        bucket = (every >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(every), np.int64)
        by = np.argsort(bucket, kind="stable")
        every, owner, bucket = every[by], owner[by], bucket[by]
        low = np.ascontiguousarray(every.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = []
        for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(bucket)], strict=True):
            first = np.flatnonzero(np.diff(owner[s:e], prepend=-1))
            own = owner[s:e][first]
            out.append((int(bucket[s]), low[s:e].tobytes(), names[own].tobytes(), widths[own].tobytes(), np.diff(first, append=e - s).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.binary()] * 4), strict=True)], names=["bucket", "keys", "nodes", "sizes", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        seen: set[int] = set()
        keys, nodes, sizes, held = [], [], [], 0
        for batch in common.slices(batches):
            for own in shingle_sets(batch.column("text")):
                if len(own) and (name := digest(own)) not in seen:
                    seen.add(name)
                    keys.append(index.keys(own))
                    nodes.append(name)
                    sizes.append(len(own))
                    held += len(keys[-1])
                    if held >= HELD_KEYS:
                        yield from rows(keys, nodes, sizes)
                        keys, nodes, sizes, held = [], [], [], 0
            if len(seen) > HELD_KEYS:
                seen.clear()
        if keys:
            yield from rows(keys, nodes, sizes)

    return docs.mapInArrow(common.tidy(run), "bucket bigint, keys binary, nodes binary, sizes binary, counts binary")


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by a column, regrouped so that no value is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(values[1:] != values[:-1])
        if held and held[-1].column(column)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if len(changes):
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def single_runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of one value of the column each."""
    for batch in runs(batches, column):
        values = batch.column(column).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(values)], strict=True):
            yield batch.slice(s, e - s)


def groups_of(keys: DataFrame) -> DataFrame:
    """GROUPS rows: the nodes that share a key, two at least, by size, in parts of about PART by hash, each with its hub; equal
    groups are one."""

    def of_bucket(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys that two rows have at least, and their nodes and sizes, sorted and distinct."""
        low = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
        key = np.zeros((len(low), 8), np.uint8)
        key[:, :KEY_BYTES] = low
        key = key.view("<u8").ravel()
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<u4")
        node, size = (np.repeat(np.frombuffer(b"".join(batch.column(c).to_pylist()), t), counts) for c, t in (("nodes", np.int64), ("sizes", "<u4")))
        by = np.argsort(key)
        same = key[by[1:]] == key[by[:-1]]
        by = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        by = by[np.lexsort((node[by], size[by], key[by]))]
        key, node, size = key[by], node[by], size[by].astype(np.int64)
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        return key[fresh], node[fresh], size[fresh]

    def hubs_of(node: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Members are by size: the first of each class of sizes, or for that one the first of the class before, if that may be
        similar."""
        of_class = np.floor(np.log(size) / np.log(4 / 3)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], of_class[1:] != of_class[:-1]]))
        first = np.repeat(heads, np.diff(heads, append=len(node)))
        out = node[first]
        for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            if 4 * size[a] >= 3 * size[b]:
                out[b] = node[a]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.drop_kept()
        for batch in single_runs(batches, "bucket"):
            key, node, width = of_bucket(batch)
            if not len(key):
                continue
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(heads, append=len(key))
            with np.errstate(over="ignore"):
                gid = np.add.reduceat(mix(node.view(np.uint64) + _U(0x9E3779B97F4A7C15)), heads).view(np.int64)
            many = np.flatnonzero(sizes > 1)
            if not len(many):
                continue
            own, place = np.unique(gid[many], return_index=True)
            out = []
            for g, k in zip(own.tolist(), many[place].tolist(), strict=True):
                own = slice(int(heads[k]), int(heads[k] + sizes[k]))
                members, hubs, parts = node[own], hubs_of(node[own], width[own]), 1
                if sizes[k] <= PART:
                    out.append((g, int(sizes[k]), 0, 1, members, hubs))
                    continue
                while parts * PART < sizes[k]:
                    parts *= 2
                dealt = (mix(members.view(np.uint64)) % _U(parts)).astype(np.int64)
                out += [(g, int(sizes[k]), p, parts, members[dealt == p], hubs[dealt == p]) for p in np.unique(dealt).tolist()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=[c.split(" ")[0] for c in GROUPS.split(", ")])

    found = keys.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(common.tidy(run), GROUPS)
    return found.groupBy("gid", "members", "part", "parts").agg(F.first(F.struct("nodes", "hubs")).alias("n")).select("gid", "members", "part", "parts", "n.nodes", "n.hubs")


class Members:
    """Sets of a group by size and parity bits."""

    def __init__(self, sizes: np.ndarray, sigs: list[bytes]):
        self.sizes, self.width = sizes, np.array([len(s) // 8 for s in sigs], np.int64)
        self.sigs = [np.frombuffer(s, "<u8") for s in sigs]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of members may be similar: by size and by parity bits."""
        sa, sb = self.sizes[a], self.sizes[b]
        fits = 4 * np.minimum(sa, sb) >= 3 * np.maximum(sa, sb)
        out = np.zeros(len(a), bool)
        for width in np.unique(np.minimum(self.width[a], self.width[b])[fits]) if fits.any() else []:
            pairs = np.flatnonzero(fits & (np.minimum(self.width[a], self.width[b]) == width))
            names = np.unique(np.concatenate([a[pairs], b[pairs]]))
            table = np.stack([self._folded(i, width) for i in names.tolist()])
            step = max(1, (1 << 21) // int(width))
            for i in range(0, len(pairs), step):
                part = pairs[i : i + step]
                x = table[np.searchsorted(names, a[part])] ^ table[np.searchsorted(names, b[part])]
                out[part] = 7 * np.bitwise_count(x).sum(1, dtype=np.int64) <= sa[part] + sb[part]
        return out

    def _folded(self, i: int, width: int) -> np.ndarray:
        bits = self.sigs[i]
        while len(bits) > width:
            bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
        return bits


def similar_by_bits(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The (u, v) that may be similar by their sizes and bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes = np.concatenate([batch.column(c).to_numpy() for c in ("size_u", "size_v")])
            own = Members(sizes, [*batch.column("sig_u").to_pylist(), *batch.column("sig_v").to_pylist()])
            yield batch.select(["u", "v"]).filter(pa.array(own.near(np.arange(n), np.arange(n, 2 * n))))

    for side in ("v", "u"):
        pairs = pairs.join(sigs.select(F.col("node").alias(side), F.col("n_shingles").alias(f"size_{side}"), F.col("sig").alias(f"sig_{side}")), side)
    return pairs.select("u", "v", "size_u", "size_v", "sig_u", "sig_v").mapInArrow(common.tidy(run), "u bigint, v bigint")


def star_pairs(groups: DataFrame) -> DataFrame:
    """(u, v): each node with the two hubs that it has in most groups."""
    every = groups.select(F.explode(F.arrays_zip("hubs", "nodes")).alias("p")).select(F.col("p.hubs").alias("u"), F.col("p.nodes").alias("v")).where("u <> v")
    often = every.groupBy("v", "u").agg(F.count("*").alias("n"))
    chosen = often.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("n", "u")), False).alias("hubs"))
    return chosen.select(F.explode(F.slice("hubs", 1, 2)).alias("h"), "v").select("h.u", "v")


def apart(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of members (gid, members, part, parts, node, comp) of the groups whose members are in several components, with the
    component that has most members there."""
    every = groups.select("gid", "members", "part", "parts", F.explode("nodes").alias("node")).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = every.groupBy("gid", "members", "comp").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
    main = several.groupBy("gid", "members").agg(F.count("*").alias("comps"), F.max(F.struct("n", "comp", "low", "high")).alias("main")).where("comps > 1")
    return every.join(main.drop("comps"), ["gid", "members"])


def apart_pairs(rows: DataFrame, seed: int) -> DataFrame:
    """(u, v): members that are not of their group's greatest component with nodes that are, two for each node."""
    others = rows.where(F.col("comp") != F.col("main.comp"))
    one = others.select(F.when(F.pmod(F.xxhash64("node", "gid", F.lit(seed)), F.lit(2)) == 0, F.col("main.low")).otherwise(F.col("main.high")).alias("u"), F.col("node").alias("v"))
    order = F.struct(F.xxhash64("u", F.lit(seed)), "u")
    chosen = one.groupBy("v").agg(F.array_distinct(F.array(F.min(order), F.max(order))).alias("us"))
    return chosen.select(F.explode("us").alias("s"), "v").select("s.u", "v")


def cross_pairs(rows: DataFrame, sigs: DataFrame) -> DataFrame:
    """(u, v): every two members of a group that are of different components and may be similar.

    Groups of one part that have their first member in common go to one task, ROUTE members or more at a time, which has each
    node's bitmap once and says each pair once.  In groups of several parts, members of the component that has most are compared
    with those of other components only; these are dealt into parts, too, and each such part meets each part of the group in
    a task.
    """
    schema = "u bigint, v bigint"

    def pairs(node: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        found = np.unique(np.stack([np.maximum(node[u], node[v]), np.minimum(node[u], node[v])], 1), axis=0)
        return pa.RecordBatch.from_pydict({"u": found[:, 0], "v": found[:, 1]})

    def between(sets: Members, comp: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        right = right[np.argsort(sets.sizes[right], kind="stable")]
        sizes = sets.sizes[right]
        step = max(1, (1 << 20) // max(len(right), 1))
        for i in range(0, len(left), step):
            some = left[i : i + step]
            low = np.searchsorted(sizes, (3 * sets.sizes[some] + 3) // 4)
            high = np.searchsorted(sizes, 4 * sets.sizes[some] // 3, side="right")
            a, b = np.repeat(some, high - low), right[common.ragged(low, high - low)]
            good = comp[a] != comp[b]
            yield a[good], b[good]

    def of_routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in single_runs(batches, "route"):
            node = batch.column("node").to_numpy(zero_copy_only=False)
            m = int(np.count_nonzero(~np.isnan(node))) if node.dtype.kind == "f" else len(node)
            members = batch.slice(0, m)
            node, comp = members.column("node").to_numpy(), members.column("comp").to_numpy()
            sets = Members(members.column("n_shingles").to_numpy(), members.column("wide").to_pylist())
            together = np.zeros((m, m), bool)
            for nodes in batch.slice(m).column("nodes"):
                own = np.searchsorted(node, nodes.values.to_numpy())
                for a, b in between(sets, comp, own, own):
                    a, b = a[a < b], b[a < b]
                    together[a, b] = True
            a, b = np.nonzero(together)
            for i in range(0, len(a), 1 << 20):
                u, v = a[i : i + (1 << 20)], b[i : i + (1 << 20)]
                good = sets.near(u, v)
                if good.any():
                    yield pairs(node, u[good], v[good])

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in single_runs(batches, "route"):
            node, comp = batch.column("node").to_numpy(), batch.column("comp").to_numpy()
            other, whole = batch.column("other").to_numpy(zero_copy_only=False), batch.column("whole").to_numpy(zero_copy_only=False)
            sets = Members(batch.column("n_shingles").to_numpy(), batch.column("wide").to_pylist())
            for a, b in between(sets, comp, np.flatnonzero(other), np.flatnonzero(whole)):
                good = sets.near(a, b)
                if good.any():
                    yield pairs(node, a[good], b[good])

    wide = sigs.select("node", "n_shingles", "wide")
    small = rows.where("parts = 1").select("gid", "members", "node", "comp")
    named = small.groupBy("gid", "members").agg(F.array_sort(F.collect_list("node")).alias("nodes")).withColumn("hub", F.element_at("nodes", 1))
    weight = named.groupBy("hub").agg(F.ceil(F.sum("members") / ROUTE).alias("chunks"))
    routed = common.materialize(named.join(weight, "hub").select(F.xxhash64("hub", F.pmod("gid", "chunks")).alias("route"), "nodes"), "routes")
    comps = rows.select("node", "comp").distinct()
    nothing = lambda kind: F.lit(None).cast(kind)
    own = routed.select("route", F.explode("nodes").alias("node")).distinct().join(comps, "node").join(wide, "node").select("route", "node", "comp", "n_shingles", "wide", nothing("array<bigint>").alias("nodes"))
    lists = routed.select("route", nothing("bigint").alias("node"), nothing("bigint").alias("comp"), nothing("bigint").alias("n_shingles"), nothing("binary").alias("wide"), "nodes")
    found = own.union(lists).repartition("route").sortWithinPartitions("route", F.asc_nulls_last("node")).mapInArrow(common.tidy(of_routes), schema)

    large = rows.where("parts > 1").drop("main")
    if large.limit(1).count():
        large = large.join(wide, "node")
        counts = large.groupBy("gid", "members", "comp").count()
        main = counts.groupBy("gid", "members").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), (F.sum("count") - F.max("count")).alias("others"))
        large = large.join(main, ["gid", "members"]).withColumn("blocks", F.ceil(F.col("others") / PART).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        columns = lambda other: (F.xxhash64("gid", "members", "part", "block").alias("route"), "node", "comp", "n_shingles", "wide", F.lit(other).alias("other"), F.lit(not other).alias("whole"))
        whole = large.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*columns(False))
        others = large.where("comp <> main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*columns(True))
        found = found.union(whole.union(others).repartition("route").sortWithinPartitions("route").mapInArrow(common.tidy(of_blocks), schema))
    return found.distinct()


def verify(pairs: DataFrame, docs: DataFrame, places: DataFrame) -> DataFrame:
    """The pairs that are similar by their whole sets.  places: (node, doc_id), a document of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route = node = None
        hub = np.zeros(0, np.uint64)
        for batch in common.slices(batches):
            routes, us, nodes = (batch.column(c).to_numpy() for c in ("route", "u", "node"))
            u, v = [], []
            for i, own in enumerate(shingle_sets(batch.column("text"))):
                if digest(own) != nodes[i]:  # another text of the same doc_id
                    continue
                if us[i] == nodes[i]:
                    route, node, hub = routes[i], nodes[i], own
                elif routes[i] == route and us[i] == node:
                    shared = len(np.intersect1d(hub, own, assume_unique=True))
                    if 100 * shared >= 75 * (len(hub) + len(own) - shared):
                        u.append(node)
                        v.append(nodes[i])
            if u:
                yield pa.RecordBatch.from_pydict({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    pairs = common.materialize(pairs, "pairs")
    partners = pairs.groupBy("u").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / PARTNERS))
    dealt = pairs.join(partners, "u").select(F.xxhash64("u", F.pmod(F.xxhash64("v"), "blocks")).alias("route"), "u", "v")
    wanted = dealt.select("route", "u", F.col("v").alias("node")).union(dealt.select("route", "u", F.col("u").alias("node")).distinct())
    wanted = common.materialize(wanted.join(places, "node"), "wanted")
    ids = wanted.select("doc_id").distinct()
    small = ids.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    both = wanted.join(texts, "doc_id").select("route", "u", "node", "text")
    return both.repartition("route").sortWithinPartitions("route", "u", F.col("u") != F.col("node")).mapInArrow(common.tidy(run), "u bigint, v bigint").distinct()


class Joined:
    """What both forms of the join start from.  docs: (doc_id, text); every row with a doc_id and a set has its node."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        with common.scratch(docs.sparkSession) as keep:
            summary = common.materialize(summarize(self.docs), "summary")
            hot = summary.where("hot is not null").groupBy("hot").agg(F.sum("hot_count").alias("n")).orderBy(F.desc("n"), "hot").limit(HOT_SHINGLES).toPandas()
            self.rows = keep(common.materialize(summary.where("n_shingles is not null").select("doc_id", "n_shingles", "node"), "rows"))
            named = summary.where("doc_id is not null and n_shingles > 0")
            sigs = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("wide").alias("wide"))
            self.sigs = keep(common.materialize(sigs, "sigs"))
        index = Index(hot["hot"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64))
        self.named = self.rows.where("doc_id is not null and n_shingles > 0")
        # a set has a key for each third shingle
        keys = (self.named.agg(F.sum("n_shingles")).first()[0] or 0) // 3
        bits = max(0, int(keys // BUCKET_KEYS).bit_length())
        self.groups = common.materialize(groups_of(index_keys(self.docs.where("doc_id is not null"), index, bits)), "groups")

    def verified(self, pairs: DataFrame) -> DataFrame:
        return common.materialize(verify(pairs, self.docs.where("doc_id is not null"), self.sigs.select("node", "doc_id")), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    with common.scratch(docs.sparkSession) as keep:
        own = Joined(docs)
        sigs = own.sigs
        links = own.verified(similar_by_bits(star_pairs(own.groups), sigs))
        # texts of one doc_id are one document
        ids = own.named.groupBy("doc_id").agg(F.count("*").alias("texts"), F.min("node").alias("u"), F.max("node").alias("v")).where("texts > 1")
        repeated = common.materialize(ids, "repeated")
        some = repeated.limit(1).count() > 0
        if some:
            links = links.union(own.named.join(repeated.where("u <> v").select("doc_id", "u"), "doc_id").select("u", F.col("node").alias("v")).where("u <> v").distinct())
        labels = components(links)
        # Then groups whose members are still apart: first some pairs, then all.
        rounds = [lambda rows, seed=seed: similar_by_bits(apart_pairs(rows, seed), sigs) for seed in range(ROUNDS)]
        for choose in (*rounds, lambda rows: cross_pairs(rows, sigs)):
            rows = common.materialize(apart(own.groups, labels.withColumnRenamed("component", "comp")), "apart")
            more = own.verified(choose(rows))
            if more.limit(1).count():
                labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
        first = own.sigs.select("node", "doc_id", "copies").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = first.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("size")).where("size > 1")
        ends = first.join(least, "component").select("node", "component_id")
        out = own.rows.join(ends, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        if some:  # also rows without words
            whole = out.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("least"))
            out = out.join(whole, "doc_id", "left").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
        return keep(common.materialize(out, "components"))


def similar_pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The join itself: all pairs of different sets that are similar, each compared by its texts.

    Returns (doc_id, set) of all rows with a doc_id and a set that is not empty, and (u, v) of sets.
    """
    with common.scratch(docs.sparkSession) as keep:
        own = Joined(docs)
        nobody = own.sigs.select("node", F.col("node").alias("comp")).limit(0)
        found = own.verified(cross_pairs(apart(own.groups, nobody), own.sigs))
        named = common.materialize(own.named.select("doc_id", F.col("node").alias("set")).distinct(), "named")
        return keep(named), keep(found)


def link_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_links: the number of other documents that are similar to any of a document's texts, for each doc_id.

    Documents of one set are counted by their number, so that copies are not expanded into pairs; only documents with
    several sets are listed.
    """
    named, links = similar_pairs(docs)
    sets = named.groupBy("doc_id").agg(F.count("*").alias("sets"))
    named = common.materialize(named.join(sets, "doc_id"), "named")
    every = named.select(F.col("set").alias("a"), F.col("set").alias("b")).distinct()
    near = common.materialize(every.union(links.select("u", "v")).union(links.select("v", "u")), "near")
    singles = named.where("sets = 1").groupBy(F.col("set").alias("b")).agg(F.count("*").alias("n"))
    several = named.where("sets > 1").select("doc_id", F.col("set").alias("b"))
    by_set = near.join(singles, "b").groupBy("a").agg(F.sum("n").alias("n"))
    listed = near.join(several, "b").groupBy("a").agg(F.count_distinct("doc_id").alias("m"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    one = named.where("sets = 1").withColumnRenamed("set", "a").join(by_set, "a", "left").join(listed, "a", "left").select("doc_id", (zero("n") + zero("m") - 1).alias("n_links"))
    reach = several.withColumnRenamed("b", "a").join(near, "a").select("doc_id", "b").distinct()
    of_singles = reach.join(singles, "b").groupBy("doc_id").agg(F.sum("n").alias("n"))
    of_several = reach.join(several.withColumnRenamed("doc_id", "other"), "b").groupBy("doc_id").agg(F.count_distinct("other").alias("m"))
    more = several.select("doc_id").distinct().join(of_singles, "doc_id", "left").join(of_several, "doc_id", "left").select("doc_id", (zero("n") + zero("m") - 1).alias("n_links"))
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    return ids.join(one.union(more), "doc_id", "left").select("doc_id", zero("n_links").alias("n_links"))


def joined_documents(docs: DataFrame) -> DataFrame:
    """Contract of op2."""
    return near_duplicates(docs)


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM worded WHERE len(ws) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, w.doc_id)::BIGINT AS component_id
FROM worded w LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest doc_id; rows with a null doc_id stay.

    Of rows that share that doc_id the first by text stays.
    """
    found = near_duplicates(docs)
    gone = common.materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:  # whole rows stay where they are
        gone = F.broadcast(gone)
    kept = docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    ids = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1)
    if not ids.count():
        return kept
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    n = common.fresh_name(kept, "_n")
    return kept.withColumn(n, number).where((F.col(n) == 1) | F.col("doc_id").isNull()).drop(n)
