"""Exact dedup: the merge tree over any number of runs, and its plan."""

import random

import pytest

from ontime.llm.exact_dedup import ROUNDS, children, digests, exact_dedup, merge_round


@pytest.mark.parametrize("n_runs", [1, 2, 8, 9, 37])
def test_tree_over_runs_matches_brute_force(spark, n_runs):
    rng = random.Random(n_runs)
    # one text in a third of the rows, groups of a few, and texts alone
    rows = [(i, "hot" if i % 3 == 0 else f"t {rng.randrange(90)}" if i % 3 == 1 else f"alone {i}") for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n_runs)
    groups = {}
    for i, text in rows:
        groups.setdefault(text, []).append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()}
    assert got == {i: (min(groups[t]), len(groups[t]), i == min(groups[t])) for i, t in rows}


def test_children_cover_all_runs():
    for n in (1, 2, 8, 9, 64, 65, 512, 513, 800_000):
        assert children(n) ** ROUNDS >= n and (children(n) == 2 or (children(n) // 2) ** ROUNDS < n)


def test_a_round_is_one_exchange_and_one_sort(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id long, text string")
    runs = digests(df).selectExpr("run", "digest", "n_chars_normal", "second_hash", "doc_id AS keep_id", "1L AS group_size")
    plan = merge_round(runs, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(run") == 1 and plan.count("Exchange ") == 1
    assert plan.count("Sort [") == 1 and "Window" in plan and "Aggregate" not in plan
