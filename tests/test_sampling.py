"""Draws by quota against plain ranks, and last posts against plain lists."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import history, review, state


def plain_quotas(strata, total):
    """One item at a time to the stratum farthest below its share."""
    weight, total = sum(w for _, _, w, _ in strata), min(total, sum(n for _, n, _, _ in strata))
    share = {s: total * w / weight if weight > 0 else 0.0 for s, _, w, _ in strata}
    got = {s: min(int(share[s]), n) for s, n, _, _ in strata}
    while sum(got.values()) < total:
        s = min((got[s] - share[s], tie, s) for s, n, _, tie in strata if got[s] < n)[2]
        got[s] += 1
    return got


@pytest.mark.parametrize("seed", range(12))
def test_quotas(spark, seed):
    r = random.Random(seed)
    strata = [(f"s{i}", r.choice([1, 2, 5, 40, 1000]), float(r.choice([1, 2, 3, 10, 97])) * r.random(), f"t{i:02}") for i in range(r.randint(1, 14))]
    for total in (0, 1, 7, 60, 900, 10**6):
        got = dict(review.quotas(spark.createDataFrame(strata, "stratum string, n long, weight double, tie string").coalesce(2), total).collect())
        assert got == plain_quotas(strata, total), (strata, total)


def test_a_draw_of_millions_has_a_row_for_each_stratum_only(spark):
    strata = spark.createDataFrame([("a", 10**9, 1.0, "a"), ("b", 5, 1000.0, "b"), ("c", 10**9, 1.0, "c")], "stratum string, n long, weight double, tie string")
    assert dict(review.quotas(strata, 10**8 + 5).collect()) == {"a": 5 * 10**7, "b": 5, "c": 5 * 10**7}


def plain_lowest(rows, quota):
    key = lambda i: (hashlib.sha256(f"7|{i}".encode()).hexdigest(), i)
    return {(i, g) for g, q in quota.items() for i in sorted((i for i, x in rows if x == g), key=key)[:q]}


@pytest.mark.parametrize("slack", [6.0, -6.0])  # below none: the first threshold leaves groups short, so higher ones follow
def test_lowest_is_the_rank_over_whole_groups(spark, slack):
    r = random.Random(3)
    rows = [(f"i{k}", r.choice(["a", "a", "a", "b", None, "d"])) for k in range(6000)]
    quota = {"a": 700, "b": 3, None: 40, "d": 10**6}
    df = spark.createDataFrame(rows, "item_id string, g string").repartition(6)
    n = df.groupBy(F.col("g").alias("of")).agg(F.count("*").alias("n")).collect()
    wanted = spark.createDataFrame([(x["of"], x["n"], quota[x["of"]]) for x in n], "of string, n long, quota long")
    got = review.lowest(df, "g", review.seeded(7), "item_id", wanted, slack)
    assert got.columns == ["item_id", "g"] and {tuple(x) for x in got.collect()} == plain_lowest(rows, quota) and got.count() == len(plain_lowest(rows, quota))


def test_lowest_ranks_few_more_than_the_quota(spark):
    df = spark.range(200_000).select(F.concat(F.lit("i"), F.col("id")).alias("item_id"), F.lit("x").alias("g"))
    wanted = spark.createDataFrame([("x", 200_000, 100)], "of string, n long, quota long")
    got = review.lowest(df, "g", review.seeded(1), "item_id", wanted)
    assert got.count() == 100
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [row_number") < plan.index("_h#") and "_cut" in plan
    below = df.filter(review.seeded(1) < F.lpad(F.lower(F.hex(F.lit(int((100 + 60 + 12) / 200_000 * (1 << 48))))), 12, "0")).count()
    assert 100 <= below < 260  # what the window gets


def test_extension_sample_with_ties_of_nothing(spark):
    rows = [(f"i{k}", "2026-06" if k % 3 else "2026-07") for k in range(300)]
    got = state.extension_sample(spark.createDataFrame(rows, "item_id string, month string"), spark.createDataFrame([("i1",)], "item_id string"), {"2026-06": 5, "2026-09": 2}, seed=7)
    assert {tuple(x) for x in got.select("item_id", "month").collect()} == plain_lowest([x for x in rows if x[0] != "i1"], {"2026-06": 5})


def plain_history(rows, hours, k):
    out = {}
    for i, a, t in rows:
        back = sorted((u, j) for j, b, u in rows if a is not None and t is not None and b == a and u is not None and t - hours * history.HOUR <= u < t)
        out[i] = [j for _, j in back[-k:]]
    return out


@pytest.mark.parametrize("span", [history.SPAN, 5 * history.HOUR, history.HOUR])
def test_last_posts_stand_equal_times(spark, span):
    r = random.Random(8)
    rows = [(i, r.choice(["a", "a", "b", None]), r.choice([None, *range(40)])) for i in range(400)]
    rows = [(i, a, None if t is None else t * 3 * history.HOUR) for i, a, t in rows]
    rows += [(1000, "one", 10 * history.HOUR)] + [(1001 + i, "one", 11 * history.HOUR) for i in range(7)]  # seven at one time, one before them
    df = spark.createDataFrame(rows, "item_id long, author string, us long").repartition(5)
    for hours, k in ((48, 5), (6, 2), (1000, 7)):
        got = {x["item_id"]: x["history"] for x in history.last_posts(df, hours, k, span=span).collect()}
        assert got == plain_history(rows, hours, k)
    assert history.last_posts(df.limit(0)).count() == 0
