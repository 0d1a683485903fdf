"""The mixture against its target weights themselves, and against a plain schedule."""

import heapq
import random
from fractions import Fraction

import pytest

from starload.llm.mixing import earliest_first, mix, whole_weights


def table(spark, sizes):
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string").repartition(4)


def shares(sizes, weights):
    """Served blocks of each source at every slot, by the definition."""
    served = {s: Fraction(0) for s in sizes}
    t, ends = Fraction(0), []
    while left := [s for s in sizes if served[s] < sizes[s]]:
        total = sum(weights[s] for s in left)
        step = min((sizes[s] - served[s]) * total / weights[s] for s in left)
        ends.append((t, {s: (served[s], weights[s] / total if s in left else 0) for s in sizes}))
        served = {s: served[s] + step * weights[s] / total if s in left else served[s] for s in sizes}
        t += step
    return lambda slot: {s: a + (slot - begin) * r for begin, state in
                         [max((e for e in ends if e[0] <= slot), key=lambda e: e[0])]
                         for s, (a, r) in state.items()}


@pytest.mark.parametrize("sizes, weights", [
    ({"hot": 900} | {f"s{i}": 10 for i in range(19)}, {"hot": 0.9} | {f"s{i}": 0.1 / 19 for i in range(19)}),
    ({"hot": 600} | {f"s{i}": 3 for i in range(300)}, {"hot": 0.5} | {f"s{i}": 0.5 / 300 for i in range(300)}),
    ({"a": 4000, "b": 5}, {"a": 0.9999, "b": 0.0001}),
    ({"a": 30, "b": 500, "c": 7, "d": 7}, {"a": 3, "b": 1, "c": 0.25, "d": 0.25}),
])
def test_less_than_a_block_from_the_target(spark, sizes, weights):
    rows = mix(table(spark, sizes), weights, block_rows=1).collect()
    assert sorted(r.mix_slot for r in rows) == list(range(sum(sizes.values())))
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    target = shares(sizes, {s: Fraction(str(w)) for s, w in weights.items()})
    done = dict.fromkeys(sizes, 0)
    for r in sorted(rows, key=lambda r: r.mix_slot):
        for s, want in target(r.mix_slot).items():
            assert abs(done[s] - want) < 1 + Fraction(1, 10**9)
        assert r.mix_block == done[r.source]
        done[r.source] += 1


def test_weight_zero_goes_last(spark):
    rows = mix(table(spark, {"a": 40, "z": 9, "b": 20}), {"a": 1, "z": 0, "b": 1}, block_rows=1).collect()
    assert sorted(r.mix_slot for r in rows if r.source == "z") == list(range(60, 69))
    with pytest.raises(ValueError):
        whole_weights({"a": -1.0})


@pytest.mark.parametrize("seed", range(3))
def test_slots_are_those_of_a_plain_schedule(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([37, 64, 90])
    # Never idle: release i of the sorted ones is i at most.
    releases = [rng.randint(max(0, i - 12), i) for i in range(n)]
    rng.shuffle(releases)
    want, ready, by_time = {}, [], sorted((r, i) for i, r in enumerate(releases))
    for slot in range(n):
        while by_time and by_time[0][0] <= slot:
            heapq.heappush(ready, by_time.pop(0)[1])
        want[heapq.heappop(ready)] = slot
    jobs = spark.createDataFrame(list(enumerate(releases)), "mix_order long, mix_release long")
    for area in (8, 256):
        got = {r.mix_order: r.mix_slot for r in earliest_first(jobs, n, area).collect()}
        assert got == want


def test_sources_that_run_out_one_by_one(spark):
    docs = spark.range(1, 301).selectExpr(
        "explode(sequence(1L, id)) AS doc_id", "concat('domain', id) AS source")
    rows = mix(docs, {f"domain{i}": 1 for i in range(1, 301)}, block_rows=1).collect()
    assert sorted(r.mix_slot for r in rows) == list(range(300 * 301 // 2))
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    # Equal weights: by turns, and a phase for each source that is left.
    assert sorted(r.source for r in rows if r.mix_slot < 300) == sorted(
        f"domain{i}" for i in range(1, 301))
    assert {r.mix_phase for r in rows} == set(range(300))
