import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from holdfast.llm import common
from holdfast.llm import token_store as ts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=700))
def test_code_round_trip(values):
    ids = np.array(values, np.uint32)
    symbols, counts = np.unique(ids, return_counts=True)
    code = ts.CanonicalCode.from_counts(symbols.astype(np.int64), counts)
    payload, offsets = code.encode(ids)
    assert code.decode(payload, offsets, len(ids)).tolist() == values


def test_lengths_are_limited_and_a_prefix_code():
    counts = np.array([int(1.7**i) + 1 for i in range(60)])
    lengths = ts.code_lengths(counts, 16)
    assert lengths.max() <= 16 and (2.0**-lengths).sum() <= 1
    assert (np.diff(lengths) <= 0).all()
    with pytest.raises(ValueError):
        ts.code_lengths(np.ones(5, int), 2)


def test_limited_codes_are_optimal():
    """No assignment of lengths within the limit is shorter."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        counts = np.sort(rng.integers(1, 200, int(rng.integers(2, 7))))[::-1]
        for limit in (3, 4, 6):
            lengths = ts.code_lengths(counts, limit)
            best = min(sum(c * n for c, n in zip(counts, own)) for own in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0**-n for n in own) <= 1)
            assert (counts * lengths).sum() == best and lengths.max() <= limit and (2.0**-lengths).sum() <= 1


def test_words_encode_as_texts():
    import pyarrow as pa

    plain = Tokenizer.from_file(public_tokenizers.path(ts.VOCABULARY))
    texts = ["It's DON'T 12ab3!?'s", "<|endoftext|>hi", "İstanbul ΣΑΣ ß straße", "éa b\x0bc\x85d", "日本語 mixed ünï—“q”", "'' ''' 'll ½²x ªº", "", "😀a", "9233a8ecf7c5b09f", "l'été d'Été", None]
    ids, sizes = ts.WordTokenizer().encode(pa.array(texts), 2)
    for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert own.tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 2]


def test_store_against_plain_encoding(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] != 4] + [(1000 - i, f"text number {i} of many, " * i) for i in range(30)]
    plain = Tokenizer.from_file(public_tokenizers.path(ts.VOCABULARY))
    expected, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in ts.token_digests(documents(rows)).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_empty(documents):
    assert ts.token_digests(documents([])).count() == 0


def test_other_operators_drop_the_tokenizer_of_a_worker():
    from holdfast.llm import common, token_store

    token_store.worker_tokenizer(None)
    assert token_store._TOKENIZERS
    common.drop_kept()
    assert not token_store._TOKENIZERS and token_store.worker_tokenizer(None)


def test_blocks_hold_at_most_their_tokens_unless_one_document_is_longer(spark, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK", 50)
    texts = ["one two three " * n for n in (1, 2, 30, 3, 4, 0, 5, 40, 1, 1)] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = ts.token_blocks(docs).collect()
    assert all(row["n_tokens"] <= 50 or len(row["doc_ids"]) == 1 for row in rows)
    assert all(sum(row["lengths"]) == row["n_tokens"] for row in rows)
    assert sorted(i for row in rows for i in row["doc_ids"]) == list(range(len(texts)))
    for shard in {row["shard"] for row in rows}:
        own = sorted((row for row in rows if row["shard"] == shard), key=lambda row: row["block"])
        assert [row["first"] for row in own] == [sum(r["n_tokens"] for r in own[:k]) for k in range(len(own))]


def test_a_task_keeps_its_own_and_drops_what_other_operators_keep(monkeypatch):
    own, other = {"a": 1}, {"b": 2}
    monkeypatch.setattr(common, "KEPT", [own, other])
    common.drop_kept(own)
    assert (own, other) == ({"a": 1}, {})


def test_a_worker_gives_back_what_its_task_has_freed():
    import psutil

    def run(batches):
        for _ in batches:
            some = [bytes(2000) for _ in range(100_000)]
            last = some[-1]
            del some
            yield last

    before = psutil.Process().memory_info().rss
    assert len(list(common.tidy(run)(iter([1, 2])))) == 2
    assert psutil.Process().memory_info().rss - before < 60e6


def test_a_worker_keeps_its_tokenizer_between_tasks(monkeypatch):
    other = {}
    monkeypatch.setattr(common, "KEPT", [ts._TOKENIZERS, other])
    first = ts.worker_tokenizer(None)
    other["b"] = 1
    assert ts.worker_tokenizer(None) is first and not other
