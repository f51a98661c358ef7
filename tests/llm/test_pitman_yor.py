import collections
import math
import re
import zlib

import numpy as np
import pytest

from holdfast.llm import common
from holdfast.llm import pitman_yor as py


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_against_counts(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] != 4] + [(100 + i, f"Common words and w{i % 7} x{i} " * (i % 5 + 1)) for i in range(60)]
    name = lambda i: "" if i is None else str(i)
    held = lambda i: zlib.crc32(name(i).encode()) % 7 == 2
    counts = collections.Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    n, types = sum(counts.values()), len(counts)
    expected = [
        (r[0], held(r[0]), len(tokens(r[1])), sum(counts[t] > 0 for t in tokens(r[1])), n, round(sum(math.log10((counts[t] + 1) / (n + types + 1)) for t in tokens(r[1])), 6)) for r in rows
    ]
    found = py.score_texts(documents(rows)).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in found), key=repr) == sorted(expected, key=repr)
    out = [r for r in found if r["held_out"] and r["n_tokens"] > 1]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(r["score"] < 0 for r in found)


def test_letter_rows_are_distributions():
    words = ["the", "then", "they", "other", "été", "x9"] * 3
    code, points, ends = py.letter_codes(words)
    keys, n = np.unique(code, return_counts=True)
    own = collections.Counter(points[points != 10].tolist())
    model = py.LetterModel(keys, n, own)
    assert np.exp(model.rows.astype(float)).sum(1) == pytest.approx(np.ones(len(model.rows)), abs=1e-4)
    seen, odd = model.log_probability(py.letter_codes(["the", "qqq"]))
    assert seen > odd


def test_seating_is_within_bounds_and_repeats():
    counts = np.array([0, 1, 2, 50, 100_000])
    mass = np.array([1.0, 1.0, 0.5, 2.0, 30.0])
    keys = np.arange(5, dtype=np.uint64)
    a, b = py.seat(counts, mass, 0.5, keys, 1), py.seat(counts, mass, 0.5, keys, 1)
    assert (a == b).all() and a[0] == 0 and a[1] == 1 and (a[2:] >= 1).all() and (a <= counts).all()


def test_empty(documents):
    assert py.score_texts(documents([])).count() == 0


def test_word_order_counts(documents):
    rng = np.random.default_rng(3)
    follows = {w: [f"w{(7 * w + k) % 40}" for k in range(2)] for w in range(40)}
    rows = []
    for i in range(200):
        own = ["w1"]
        while len(own) < 30:
            own.append(follows[int(own[-1][1:])][int(rng.integers(2))])
        rows.append((i, " ".join(own)))
    held = next(i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 7 == 2)
    fluent = rows[0][1]
    scrambled = " ".join(rng.permutation(fluent.split()))
    found = {r["doc_id"]: r for r in py.score_texts(documents([*rows, (held, scrambled)])).collect()}
    assert found[0]["base_score"] == pytest.approx(found[held]["base_score"])
    assert found[0]["score"] > found[held]["score"] + 10


def test_late_customers_are_sampled():
    m = 4000
    keys = np.arange(m, dtype=np.uint64)
    got = py.seat(np.full(m, 1000), np.full(m, 3.0), 0.5, keys, 1)
    rng, one_by_one = np.random.default_rng(1), np.ones(m)
    for k in range(1, 1000):
        one_by_one += rng.random(m) < 3.0 / (3.0 + k - 0.5 * one_by_one)
    assert got.mean() == pytest.approx(one_by_one.mean(), rel=0.05)
    assert got.std() == pytest.approx(one_by_one.std(), rel=0.1)


def test_letters_are_served_to_tables():
    few, many = (py.letter_model(*py.letter_keys(py.letter_codes(["ab", "xy"]), np.array([n, 1.0]))) for n in (1.0, 50.0))
    seen = py.letter_codes(["ab"])
    assert many.log_probability(seen)[0] > few.log_probability(seen)[0] + 0.3


@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
def test_probabilities_sum_to_one(documents, shard_bytes):
    """In every context, over all words and the unseen type; counts and sums of tables are the corpus's, over many shards."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.6, 25) % 30) + f" only{i}") for i in range(60)]
    model = py.Restaurants(common.materialize(py.shard_texts(documents(rows).repartition(2), shard_bytes), "shards"))
    sweeps = model.sweeps

    def step(shard, tables):
        out = []
        for now in sweeps:
            after, before = tables[py.TABLES + now.number - 1]
            bases, seats = now.words(shard, before)
            pairs = now.pairs(shard, after, now.chances(bases, before, seats, now.tables))
            served = tables[py.TABLES + now.number][0]
            mine = shard.own & (shard.counts > 0)
            out.append((now.number, 0, 0, now.chances(bases, before, seats, now.seated)[mine].sum(), 0.0, 0.0, 0.0))
            rest = np.bincount(shard.u, (shard.pair_counts - now.pair_discount * pairs) * shard.own_pairs * (shard.pair_counts > 0), len(shard.names))
            own_tables = np.bincount(shard.u, pairs * shard.own_pairs, len(shard.names))
            for u in np.flatnonzero(shard.counts > 0).tolist():
                out.append((now.number, 1, int(shard.names[u].view(np.int64)), rest[u], own_tables[u], served[u], shard.counts[u]))
        return py._rows(out, "k int, kind int, name bigint, a double, b double, served double, c double")

    found = model.over(step, "k int, kind int, name bigint, a double, b double, served double, c double").toPandas()
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = collections.Counter(t for r in learnt for t in tokens(r[1]))
    for now in sweeps:
        words = found[(found.k == now.number) & (found.kind == 0)]["a"].sum()
        assert words + now.unseen == pytest.approx(1, abs=1e-6)
        of_contexts = found[(found.k == now.number) & (found.kind == 1)].groupby("name").agg({"a": "sum", "b": "sum", "served": ["min", "max"], "c": ["min", "max"]})
        assert len(of_contexts) == len(counts) and sorted(of_contexts[("c", "min")]) == sorted(counts.values())
        assert (of_contexts[("c", "min")] == of_contexts[("c", "max")]).all() and (of_contexts[("served", "min")] == of_contexts[("served", "max")]).all()
        assert (of_contexts[("b", "sum")] == of_contexts[("served", "min")]).all()
        whole = (of_contexts[("a", "sum")] + py.STRENGTH + now.pair_discount * of_contexts[("served", "min")]) / (py.STRENGTH + of_contexts[("c", "min")])
        assert whole.to_numpy() == pytest.approx(np.ones(len(whole)))


def test_shards_do_not_change_counts_and_little_else(documents):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.5, 30) % 40)) for i in range(80)] + [(100, None), (None, "w1 w2"), (101, "w1 " * 3000)]
    one, many = ({r["doc_id"]: r for r in py.score_texts(documents(rows), b).collect()} for b in (1 << 20, 400))
    assert all(one[i][:5] == many[i][:5] and one[i]["base_score"] == pytest.approx(many[i]["base_score"]) for i in one)
    assert all(one[i]["score"] == pytest.approx(many[i]["score"], rel=1e-6) for i in one)


def test_contexts_beat_single_words_on_held_out_texts(documents):
    """Perplexity of held-out texts: the model against the smoothed counts of single words."""
    rng = np.random.default_rng(5)
    follows = {w: rng.choice(60, 3) for w in range(60)}
    rows = []
    for i in range(300):
        own = [int(rng.integers(60))]
        while len(own) < 40:
            own.append(int(rng.choice(follows[own[-1]])))
        rows.append((i, " ".join(f"w{w}" for w in own)))
    held = [r for r in py.score_texts(documents(rows)).collect() if r["held_out"]]
    bits = lambda c: -sum(r[c] for r in held) / sum(r["n_tokens"] for r in held)
    assert bits("score") < 0.6 * bits("base_score")


def test_names_tell_words_apart():
    words = ["a", "a\0", "a\0b", "\0", "\0a", "é", "ab"]
    names = py.word_names(words)
    assert len(set(names.tolist())) == len(words) + 1 and names[-1] == py.BOUNDARY
    assert py.word_names(words[::-1])[:-1].tolist() == names[:-1][::-1].tolist() and len(py.word_names([])) == 1


def test_sorting_is_that_of_the_hashes():
    """Few upper bits, so that many hashes share them without being equal."""
    made = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (50_000, 1 << 20), (50_000, 1 << 63), (1000, 4)):
        hashes = made.integers(0, top, n, dtype=np.uint64)
        found, ordered = py.sorting(hashes)
        assert (hashes[found] == np.sort(hashes)).all() and (ordered == np.sort(hashes)).all() and (np.sort(found) == np.arange(n)).all()


def test_seating_against_one_dish_at_a_time():
    """Dishes are seated alike whatever others are seated with them, up to those that sit one by one and beyond."""
    made = np.random.default_rng(2)
    customers = np.concatenate([np.arange(0, 40), made.integers(0, 3000, 60)])
    mass, keys = made.random(100) * 3, made.integers(0, 1 << 63, 100, dtype=np.uint64)
    every = py.seat(customers, mass, 0.6, keys, 1)
    alone = [py.seat(customers[i : i + 1], mass[i : i + 1], 0.6, keys[i : i + 1], 1)[0] for i in range(100)]
    assert every.tolist() == alone and (every <= customers).all()
    for i in np.flatnonzero((customers > 0) & (customers <= py.ONE_BY_ONE)):
        tables = 1
        for k in range(1, int(customers[i])):
            tables += py.uniforms(keys[i : i + 1], 1000 + k)[0] < mass[i] / (mass[i] + k - 0.6 * tables)
        assert every[i] == tables
