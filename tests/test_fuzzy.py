import functools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import INVOICES, VENDORS, frame, invoice, rows
from starload.functions.text import containing_pattern, pattern_fragments
from starload.operators import fuzzy
from starload.operators.fuzzy import blocked_pairs, distinct_names, fuzzy_join, nested_pairs


@functools.cache
def like(text, pattern):
    """LIKE with backslash escapes, as the source database evaluates it."""
    if pattern == "":
        return text == ""
    head, rest = pattern[0], pattern[1:]
    if head == "%":
        return like(text, rest) or (text != "" and like(text[1:], pattern))
    if head == "_":
        return text != "" and like(text[1:], rest)
    if head == "\\" and rest:
        head, rest = rest[0], rest[1:]
    return text != "" and text[0] == head and like(text[1:], rest)


def matches(a, b):
    a, b = a.lower(), b.lower()
    return like(a, f"%{b}%") or like(b, f"%{a}%")


def brute(left, right):
    return sorted({(a.lower(), b.lower()) for a in left for b in right if matches(a, b)}, key=repr)


def names(spark, values):
    return distinct_names(frame(spark, "n string", *[(v,) for v in values]), "n")


ODD = ["", "%", "_", "__", "%_%", "a", "a_c", "xabcx", "50%", "50 percent", "a\\b", "a\\\\b",
       "a\\", "a\\%b", "a%b", "ab", "a%", "\\", "\\%", "\\\\", "Acme Steel", "ACME",
       "acme steel ltd", "x\ny", "x_y"]


@pytest.mark.parametrize("pairs", [nested_pairs, blocked_pairs])
def test_odd_names(spark, pairs):
    got = rows(pairs(names(spark, ODD), names(spark, ODD)), "left", "right")
    assert got == brute(ODD, ODD)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6))
def test_random_names(spark, seed):
    pick = random.Random(seed)

    def some(n):
        return ["".join(pick.choice("abAB%_\\ ") for _ in range(pick.randrange(7)))
                for _ in range(n)]

    left, right = some(25), some(25)
    want = brute(left, right)
    assert rows(blocked_pairs(names(spark, left), names(spark, right)), "left", "right") == want
    assert rows(nested_pairs(names(spark, left), names(spark, right)), "left", "right") == want


def test_pattern_text(spark):
    df = frame(spark, "n string", ("a\\b",), ("a\\",), ("a\\%b_c",))
    got = df.select("n", containing_pattern(F.col("n")), pattern_fragments(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [
        ("a\\b", "%ab%", ["ab"]), ("a\\", "%a\\%", ["a%"]), ("a\\%b_c", "%a\\%b_c%", ["a%b", "c"]),
    ]


def test_null_names_match_nothing(spark):
    left = frame(spark, INVOICES, invoice("i1", None, "2024-01-01", "1"),
                 invoice("i2", "x", "2024-01-01", "1"))
    right = frame(spark, VENDORS, ("v1", None), ("v2", "X"), ("v3", ""))
    got = fuzzy_join(left, right, "supplier_name", "vendor_name")
    assert rows(got, "avenue_created_invoice_id", "vendor_id") == [("i2", "v2"), ("i2", "v3")]


def test_blocked_form_is_equi_joined(spark):
    left = names(spark, ["alpha beta", "gamma"])
    right = names(spark, ["alpha", "ma", "a_p"])
    plan = blocked_pairs(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_only_the_many_stretches_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "FEW_GRAMS", 20)
    texts = [f"customer#{i:05d} steel" for i in range(40)]
    asked = [f"#{i:05d} s" for i in range(40)] + ["1", "12", "st"]
    grams = frame(spark, "gram string", *[(g,) for g in asked])
    held = fuzzy.pieces_of(names(spark, texts), grams)
    plan = held._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # The three short ones are sent to the names; only the pieces of 8 characters are shuffled.
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert rows(held, "text", "gram") == sorted((t, g) for t in texts for g in asked if g in t)
    spread = fuzzy.spread_of(names(spark, texts), grams)
    assert rows(spread, "gram", "n_texts") == sorted((g, sum(g in t for t in texts)) for g in asked)


@pytest.mark.parametrize("few", [0, 30, 10**6])
def test_long_names_by_any_number_of_stretches(spark, monkeypatch, few):
    monkeypatch.setattr(fuzzy, "FEW_GRAMS", few)
    left = [f"Customer#{i:09d} {s}" for i, s in zip(range(0, 900, 37), ["STEEL", "Steel works"] * 20)]
    left += ["steel", "a_b", "customer%works", "", None, left[3].replace("0", "_"), "x" * 30]
    right = [f"customer#{i:09d}" for i in range(0, 900, 74)] + [left[5], left[6].replace("0", "_")]
    right += ["customer%works", "er#000000__7", "00003_ st", "x" * 12, "x" * 9 + "_" + "x" * 11, "#%0 st%ks", "\\_", "%"]
    want = brute([n for n in left if n is not None], right)
    assert rows(blocked_pairs(names(spark, left), names(spark, right)), "left", "right") == want


def test_long_runs_are_weighed_by_few_stretches(spark):
    run = "abcdefghijklmnopqrstuvwxyz#1"
    for n in (7, 8, 9, 11, 12, 13, 28):
        got = frame(spark, "run string", (run[:n],)).select(fuzzy._longest_grams(F.col("run"))).first()[0]
        assert got[0] == run[:min(n, 8) if n >= 8 else 5]
        assert all(g in run[:n] for g in got) and len(got) <= 1 + (n + 3) // 4
        assert all(any(run[i:i + 5] in g for g in got) for i in range(n - 4))


def test_needles_longer_than_all_texts_are_left_out(spark):
    least = {"": 0, "_": 1, "\\_": 1, "a\\": 2, "__": 2, "%_%a": 2, "\\\\_": 2, "a\\b_": 3, "_%_\\%": 3, "a_b": 3}
    needles = names(spark, list(least))
    for n in range(4):
        got = fuzzy.possible(names(spark, ["x" * n]), needles)
        assert rows(got, "name") == sorted([(k,) for k, size in least.items() if size <= n], key=repr)
    # Without texts nothing is found, and nothing fails.
    none = names(spark, [None])
    assert rows(blocked_pairs(none, needles)) == rows(blocked_pairs(needles, none)) == []
