import random

import pytest
from pyspark.sql import functions as F

from spoolway.operators import skew
from spoolway.operators.skew import broadcast_small, numbered, running_totals, skew_join


def uneven_rows(seed, n=3000):
    """A third of the rows in one group, order values bunched and tied on the first column."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice([f"g{k}" for k in range(40)] + [None])
        first = rng.choice([0, 0, 0, rng.randrange(5), rng.randrange(10**9), -rng.randrange(10**6)])
        rows.append((group, first, i, rng.randrange(100)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [10_000, 100, 20])
def test_running_totals_match_a_plain_scan(spark, limit):
    rows = uneven_rows(limit)
    df = spark.createDataFrame(rows, "g string, a bigint, b bigint, v bigint").repartition(6)
    totals = {"n": F.lit(1).cast("bigint"), "total": F.col("v")}
    got = running_totals(df, ["g"], ["a", "b"], totals, limit)
    assert got.columns == ["g", "a", "b", "v", "n", "total"]
    seen, want = {}, {}
    for g, _, b, v in sorted(rows, key=lambda r: (r[1], r[2])):
        n, total = seen.get(g, (0, 0))
        seen[g] = want[b] = (n + 1, total + v)
    assert {r.b: (r.n, r.total) for r in got.collect()} == want


def test_hot_groups_are_cut_into_many_windows(spark):
    df = spark.range(2000).select(F.lit("x").alias("g"), F.col("id"))
    plan = numbered(df, ["g"], ["id"], "n", limit=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_slot0" in plan
    rows = numbered(df, ["g"], ["id"], "n", limit=100).collect()
    assert sorted((r.id, r.n) for r in rows) == [(i, i + 1) for i in range(2000)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_a_plain_join(spark, how):
    left = spark.createDataFrame(uneven_rows(7), "g string, a bigint, b bigint, v bigint")
    right = spark.createDataFrame([("hot", 1), ("g1", 2), ("g2", 3), ("none", 4)], "g string, w int")
    plain = sorted(map(repr, left.join(right, "g", how).collect()))
    assert sorted(map(repr, skew_join(left, right, ["g"], how, limit=50).collect())) == plain


def test_only_small_sides_are_marked_for_broadcast(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_small(spark.range(10), 10))
    assert "broadcast" not in plan(broadcast_small(spark.range(11), 10))


@pytest.mark.parametrize("limit", [10_000, 10])
def test_order_values_at_both_ends_of_a_long(spark, limit):
    ends = [-(2**63), -(2**62), -12, 0, 7, 2**62, 2**63 - 1]
    rows = [("g", x, i) for x in ends for i in range(9)]
    df = spark.createDataFrame(rows, "g string, a bigint, b bigint")
    got = {(r.a, r.b): r.n for r in numbered(df, ["g"], ["a", "b"], "n", limit).collect()}
    assert got == {(a, b): i + 1 for i, (_, a, b) in enumerate(sorted(rows))}


def test_a_task_sorts_a_bounded_number_of_rows(spark, monkeypatch):
    """The windows' tasks follow from the rows, also where a column of the group is constant."""
    monkeypatch.setattr(skew, "ROWS_PER_SORT", 100)
    df = spark.range(2000).select(F.lit("x").alias("t"), (F.col("id") % 50).alias("g"), "id")
    found = numbered(df, ["t", "g"], ["id"], "n", limit=100)
    assert found.rdd.getNumPartitions() == 40
    assert sorted((r.id, r.n) for r in found.collect()) == [(i, i // 50 + 1) for i in range(2000)]


def test_a_join_of_large_sides_is_dealt_by_rows(spark):
    left, right = spark.range(1000).select((F.col("id") % 100).alias("g"), "id"), spark.range(100).withColumnRenamed("id", "g")
    joined = skew_join(left, right.hint("merge"), ["g"], tasks=17)
    assert joined.rdd.getNumPartitions() == 17
    assert joined.count() == 1000
