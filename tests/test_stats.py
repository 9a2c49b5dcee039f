"""Distributed group statistics against brute force, hot groups included."""

import random
import statistics
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.functions import stats


def test_exact_median_matches_brute_force_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", round(rnd.random(), 3)) for _ in range(3000)]
    rows += [(f"k{i % 7}", rnd.choice([0.0, -2.5, 1.0, 7.25, rnd.random()])) for i in range(900)]
    rows += [("one", 0.4), ("pair", 0.1), ("pair", 0.2), ("none", None)]
    got = {r.k: r for r in stats.exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    want = defaultdict(list)
    for k, v in rows:
        if v is not None:
            want[k].append(v)
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k]["median"] == statistics.median(values)
        assert (got[k].n, got[k]["min"], got[k]["max"]) == (len(values), min(values), max(values))


def test_exact_median_carries_the_newest_date(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("a", 0.3, 9), ("a", 0.2, 4)], "k string, v double, d int")
    row = stats.exact_median(df, ["k"], "v", newest="d").first()
    assert (row["median"], row.d) == (0.2, 9)


def test_number_rows_and_folded_state_across_slices(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else "cold", i, rnd.randint(0, 4)) for i in range(400)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t int, v int")
    slices = F.floor(F.col("t") / 10)
    numbered = {(r.k, r.t): r.rn for r in stats.number_rows(df, ["k"], [F.col("t")], slices).collect()}
    sized = stats.number_rows(df, ["k"], [F.col("t")], slices, total="all").collect()
    assert {(r.k, r["all"]) for r in sized} == {(k, sum(x == k for x, _, _ in rows)) for k in ("hot", "cold")}
    entry = F.struct(F.col("v").alias("v"), F.col("t").alias("t"))
    before = {(r.k, r.t): r.p and tuple(r.p) for r in stats.state_before(df, ["k"], [F.col("t")], slices, entry, "p").collect()}
    for key in ("hot", "cold"):
        own = sorted((t, v) for k, t, v in rows if k == key)
        for i, (t, _) in enumerate(own):
            assert numbered[key, t] == i + 1
            assert before[key, t] == (max((v, u) for u, v in own[:i]) if i else None)


def test_medians_of_money_and_of_single_values(spark):
    rnd = random.Random(9)
    rows = [("money", round(rnd.lognormvariate(10, 3), 2)) for _ in range(2500)] + [("money", 1e12)] + [("same", 5.0)] * 700 + [("neg", -float(i * i)) for i in range(99)]
    got = {r.k: (r["median"], r.n) for r in stats.exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got == {k: (statistics.median([v for x, v in rows if x == k]), sum(x == k for x, _ in rows)) for k in ("money", "same", "neg")}


def test_large_groups_are_cut_and_small_ones_ordered_whole_with_the_same_medians(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [("hot", rnd.choice([None, round(rnd.random(), 3)])) for _ in range(2000)]
    rows += [(f"k{i % 40}", rnd.choice([None, 0.5, rnd.random()])) for i in range(400)] + [("none", None)] * 3
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count(F.lit(1)).alias("_c")).cache()
    want = {k: [v for x, v in rows if x == k and v is not None] for k, _ in rows}
    whole = stats.median_of_counts(counts, ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in whole and "LeftSemi" in whole
    for limit in (0, 100, 1_000_000):
        monkeypatch.setattr(stats, "WHOLE", limit)
        plain = {r.k: (r["median"], r.n, r["min"], r["max"]) for r in stats.median_of_counts(counts, ["k"], "v").collect()}
        assert plain == {k: (statistics.median(v), len(v), min(v), max(v)) for k, v in want.items() if v}
        rest = stats.median_of_counts(counts, ["k"], "v", also=[F.sum("_c").alias("all")]).collect()
        assert {r.k: (r["median"], r["all"]) for r in rest} == {
            k: (statistics.median(v) if v else None, sum(x == k for x, _ in rows)) for k, v in want.items()}
