from collections import defaultdict

import pytest

from holdfast.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


@pytest.fixture(scope="module")
def rows():
    own = [(i, "w " * (i * 7 % 50), "en", f"s{i % 7 if i % 3 else 0}") for i in range(600)]
    return own + [(None, "a b c", "en", None), (601, None, "en", None), (602, "x y", "en", "tiny"), (602, "x y", "en", "tiny"), (603, "", "en", "empty")]


def test_targets_and_takes(documents, rows):
    found = mixing.mix_sources(documents(rows)).collect()
    sizes, taken, largest, targets = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        targets[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    assert len(found) == len(rows)
    assert targets == pytest.approx(brute_targets(dict(sizes)))
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.mix_sources(documents(rows)).collect()), key=repr)


def test_mix_repeats_rows_in_order(documents, rows):
    mixed = mixing.mix(documents(rows))
    assert mixed.columns == [*documents(rows).columns, "_position"]
    out = mixed.collect()
    counts = defaultdict(int)
    for r in out:
        counts[r["doc_id"]] += 1
    plan = defaultdict(int)
    for r in mixing.plan_mix(documents(rows)).collect():
        plan[r["doc_id"]] += r["copies"]
    assert {k: v for k, v in plan.items() if v} == dict(counts)
    places = [r["_position"] for r in out]
    assert places == sorted(places) and min(places) >= 0 and max(places) <= 1


def test_schedule_is_inverted(spark):
    from pyspark.sql import functions as F

    for k in range(3):
        got = spark.range(0, 11).select(mixing.position_at(F.col("id") / 10, F.lit(k)).alias("t")).collect()
        for share, r in zip([i / 10 for i in range(11)], got):
            a, b = mixing.SCHEDULES[k][0][1], mixing.SCHEDULES[k][-1][1]
            t = r["t"]
            assert a * t + (b - a) * t * t / 2 == pytest.approx(share)


def test_empty(documents):
    assert mixing.mix_sources(documents([])).count() == 0
    assert mixing.mix(documents([])).count() == 0
    assert [r["taken"] for r in mixing.mix_sources(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_whole_rows_are_exchanged_once_before_they_are_ordered(spark, documents, rows):
    """Numbers of equal rows and the join with the plan share one exchange; the other is by position."""
    import re

    out = mixing.mix(documents(rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.split("\n") if re.search(r"Exchange (?:hash|range)partitioning\(_(?:key|position|n|id|source)#", x)]) == 3  # rows, plan, order
    assert sorted(r["doc_id"] for r in out.where("doc_id = 602").collect()) == [602] * (out.where("doc_id = 602").count())


def test_equal_rows_are_paired_with_plan_rows_of_their_own(documents):
    """Copies of one row, some of which the last part pass takes: as many as the plan has, whatever their other columns."""
    from collections import Counter

    made = documents([(1, "a b c d", "en", "x")] * 5 + [(None, "a b", "en", None)] * 3 + [(i, "w " * 9, "en", "y") for i in range(10, 40)])
    planned = Counter()
    for r in mixing.plan_mix(made).collect():
        planned[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixing.mix(made).collect()) == Counter({k: n for k, n in planned.items() if n})
