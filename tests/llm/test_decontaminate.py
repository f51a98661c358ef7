import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    out = []
    for text in texts:
        own, hit, found = split(text), set(), set()
        for name, item in items:
            words = split(item)
            n = min(13, len(words))
            for i in range(len(words) - n + 1 if words else 0):
                for at in range(len(own) - n + 1):
                    if own[at : at + n] == words[i : i + n]:
                        hit.update(range(at, at + n))
                        found |= {str(name)} - {"None"}
        out.append((len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(own)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=4), st.lists(st.lists(st.integers(0, 3), max_size=16), min_size=1, max_size=3))
def test_shard_finds_what_scanning_finds(texts, items):
    say = lambda own: " ".join("abcd"[i] for i in own)
    named = [(str(k), say(x)) for k, x in enumerate(items)]
    n, spans, found = dc.search_shard(dc.Phrases([(k, x.encode()) for k, x in named]), [say(t).encode() for t in texts])
    mine = [(a, sum(e - s for s, e in b), len(c)) for a, b, c in zip(n, spans, found)]
    assert mine == [r[:3] for r in brute([say(t) for t in texts], named)]


def test_suffix_array_and_index():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 500)
    index = dc.FMIndex(text.copy(), 3)
    for n in (1, 2, 5):
        pattern = text[100 : 100 + n][None, :]
        first, end = index.search(pattern, np.array([n]))
        at = sorted(index.locate(np.arange(first[0], end[0])).tolist())
        assert at == [i for i in range(501 - n) if (text[i : i + n] == pattern[0]).all()]


@pytest.fixture(scope="module")
def case(odd_rows):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["É", "ß"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 13, 20, 40])))) for i in range(12)] + [(None, "alone x y z"), (3, "again under one id"), (20, None), (21, "")]
    texts = [(100 + i, " ".join(rng.choices(words, k=60)) + ", " + rng.choice(items[:12])[1].upper() + ". end alone x y z") for i in range(40)]
    return odd_rows + texts, items


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_against_brute_force(spark, documents, case, block):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    marks = dc.verdicts(dc.mark(documents(rows), bench, block_bytes=block)).collect()
    mine = sorted(((r["doc_id"], *tuple(r)[1:]) for r in marks), key=repr)
    theirs = sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], items))), key=repr)
    assert mine == theirs
    kept = dc.keep_clean(documents(rows), bench, block_bytes=block)
    assert kept.columns == documents(rows).columns
    assert kept.count() == sum(not b[4] for b in (t[1:] for t in theirs))


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r)[1:4] for r in dc.contaminated_documents(documents([(1, "a b")]), bench).collect()] == [(2, 0, 0)]
    assert dc.contaminated_documents(documents([]), bench).count() == 0


def test_cutting_spans():
    assert dc.cut_spans("One, two; THREE four.".encode(), [(1, 3)]) == b"One,  four."
    assert dc.cut_spans(b"a b", []) == b"a b"


def test_long_texts_are_cut_with_an_overlap():
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcd", k=k)) for k in (400, 0, 7, 90)]
    items = [(str(i), " ".join(rng.choices("abcd", k=6))) for i in range(5)] + [("long", texts[0][300:360])]
    phrases = dc.Phrases([(k, x.encode()) for k, x in items])
    whole = dc.Shard([t.encode() for t in texts]).search(phrases)
    assert [(a, sum(e - s for s, e in b), len(c)) for a, b, c in zip(*whole)] == [r[:3] for r in brute(texts, items)]
    for most in (20, 37, 64):
        assert dc.Shard([t.encode() for t in texts], most=most).search(phrases) == whole


def test_blocks_do_not_change_what_is_cut(spark, documents):
    """Overlapping items, in one block and in several."""
    words = [f"b{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[6:40]))], "item_id bigint, text string")
    docs = documents([(1, "head " + " ".join(words) + " tail"), (2, None), (3, "clean text")])
    cuts = [[r["text"] for r in dc.clean_texts(docs, bench, block_bytes=b).orderBy("doc_id").collect()] for b in (1 << 20, 10)]
    assert cuts[0] == cuts[1] == ["head  tail", None, "clean text"]
    assert dc.clean_texts(docs, bench).columns == docs.columns
