import random
import re

import numpy as np
import pytest

from holdfast.llm import jaccard_join as jj


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return [(i, len(s), top(i)) for i, s in sets]


def near_copies(seed, groups=14):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line = [word() for _ in range(30)]
    rows, n = [], 0
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 20, 40, 90, 300]))] + (line if rng.random() < 0.4 else [])
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[word()], [], [own[at], word()]])
                own = own or [word()]
            rows.append((n, " ".join(own)))
            n += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, odd_rows, seed):
    rows = [(None if i is None else i + 10_000, t) for i, t, *_ in odd_rows] + near_copies(seed, 30)
    found = sorted(map(tuple, jj.near_duplicates(documents(rows)).collect()), key=repr)
    assert found == sorted(brute(rows), key=repr)


def test_every_similar_pair_shares_a_key():
    """The pigeonhole, on sets at the very edge of similarity."""
    rng = np.random.default_rng(7)
    for trial in range(400):
        size = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
        lost = int(rng.integers(0, len(a) // 4 + 1))
        added = int(rng.integers(0, len(a) // 3 + 1))
        b = np.unique(np.concatenate([a[lost:], rng.integers(0, 1 << 62, added, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if len(b) and 100 * shared >= 75 * (len(a) + len(b) - shared):
            hot = rng.choice(a, min(5, len(a)))
            index = jj.Index(hot, np.full(len(hot), 50))
            assert len(np.intersect1d(index.keys(a), index.keys(b))), (trial, size)


def test_parity_bits_never_exclude_a_similar_pair():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(4, 300)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[len(a) // 8 :], rng.integers(0, 1 << 62, len(a) // 8, dtype=np.uint64)]))
        own = jj.Members(np.array([len(a), len(b)]), [jj.parity_bits(a), jj.parity_bits(b)])
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 75 * (len(a) + len(b) - shared):
            assert own.near(np.array([0]), np.array([1]))[0]


def test_keep_one(documents, odd_rows):
    rows = [(i, t) for i, t, *_ in odd_rows]
    kept = jj.keep_one(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, None, 4, 5, 7, 8], key=repr)


def test_empty(documents):
    assert jj.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_every_link_is_counted(documents, odd_rows, seed):
    """Also inside groups of near copies, and where a doc_id has several texts."""
    rows = [(None if i is None else i + 10_000, t) for i, t, *_ in odd_rows if i != 4] + near_copies(seed, 20)
    base = [f"w{k}" for k in range(60)]
    rows += [(20_000 + k, " ".join([*base[:58], f"x{k}", "y"])) for k in range(6)]
    rows += [(20_000, " ".join(base)), (20_007, "other words of no one else at all"), (20_007, " ".join(base)), (20_008, " ".join(base))]
    own = {}
    for i, t in rows:
        if i is not None:
            own.setdefault(i, []).append(shingles(t))
    near = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    expected = {i: sum(j != i and any(near(a, b) for a in x for b in y) for j, y in own.items()) for i, x in own.items()}
    assert max(expected.values()) >= 7
    assert {r["doc_id"]: r["n_links"] for r in jj.link_counts(documents(rows)).collect()} == expected
