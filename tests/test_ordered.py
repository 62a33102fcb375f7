import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkdeck.operators import ordered


def rows_by(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; ordering values have gaps and the table arrives shuffled."""
    rng = random.Random(3)
    rows = [(1 if i % 3 else i % 20, i * 7 % 1009, rng.choice([None, 0.0, 0.0, 1.0, 2.0]), rng.choice(["a", "a", "b"])) for i in range(1000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, t int, v double, s string")


def same(f):
    """One block and many give the same rows; a plain window is the judge in the tests below."""
    whole, cut = f(1), f(40)
    cols = whole.columns
    assert rows_by(whole) == rows_by(cut.select(*cols))


def test_cut_keys_give_the_same_running_values(skewed):
    same(lambda n: ordered.row_index(skewed, ["k"], ["t"], partitions=n))
    same(lambda n: ordered.running_sum(skewed.fillna(0.0), ["k"], ["t"], "v", "total", partitions=n))
    same(lambda n: ordered.row_index(skewed, [], ["t", "k"], partitions=n))


def test_cut_keys_give_the_same_runs(skewed):
    same(lambda n: ordered.state_run_length(skewed, ["k"], ["t"], ["v", "s"], partitions=n))
    same(lambda n: ordered.state_run_length(skewed, ["k"], ["t"], ["s"], when_null=("v", ["k"]), partitions=n))
    same(lambda n: ordered.nonzero_run(skewed, ["k"], ["t"], "v", partitions=n))


def test_cut_keys_give_the_same_fill_and_returns(skewed):
    same(lambda n: ordered.interpolate(skewed, ["k"], "t", "v", "f", partitions=n).withColumn("f", F.round("f", 9)))
    same(lambda n: ordered.interpolate(skewed, ["k"], "t", "v", "f", True, n).withColumn("f", F.round("f", 9)))
    same(lambda n: ordered.period_return(skewed, ["k"], ["t"], "v", partitions=n))


def numbered(df, by, order):
    """Row numbers from the walk and from a plain window agree on every row."""
    window = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    both = ordered.row_index(df, by, order, partitions=30).withColumn("want", F.row_number().over(window))
    assert both.count() == df.count()
    assert both.filter("idx <> want").count() == 0


def test_text_that_starts_alike_then_another_column(spark):
    rows = [(f"https:{i % 20:02d}", i) for i in range(400)]
    numbered(spark.createDataFrame(rows, "name string, id int"), [], ["name", "id"])


def test_nulls_infinities_and_nan(spark):
    values = [None, float("-inf"), float("inf"), float("nan"), 0.0, -1.5]
    rows = [(values[i % 6], i) for i in range(400)]
    numbered(spark.createDataFrame(rows, "v double, id int"), [], ["v", "id"])
    two = spark.createDataFrame([(None if i % 2 else float("-inf"), i) for i in range(400)], "v double, id int")
    numbered(two, [], ["v", "id"])


def test_long_ids_and_wide_decimals(spark):
    rows = [(2**60 + i % 20, i) for i in range(400)]
    numbered(spark.createDataFrame(rows, "big bigint, id int"), [], ["big", "id"])
    wide = spark.createDataFrame([(Decimal(10**25 + i % 20), i) for i in range(400)], "d decimal(38,0), id int")
    numbered(wide, [], ["d", "id"])


def test_null_key_and_text_order(spark):
    rows = [(None if i % 2 else "x", f"id{i:04d}", float(i % 5)) for i in range(300)]
    numbered(spark.createDataFrame(rows, "k string, o string, v double"), ["k"], ["o"])


def test_hot_keys_with_disjoint_ranges_are_cut_evenly(spark):
    df = spark.range(8000).select((F.col("id") % 8).alias("k"), (F.col("id") + (F.col("id") % 8) * 10**6).alias("t"))
    numbered(df, ["k"], ["t"])
    walk = ordered.Walk(df, ["k"], ["t"], 80)
    largest = walk.df.groupBy("k", ordered.BLOCK).count().agg(F.max("count")).first()[0]
    assert largest <= 200
    assert walk.cut.count() <= 80


def test_run_length_by_hand(spark):
    states = ["a", "a", "b", "b", "b", None, "b", "b"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(states)], "k int, t int, s string")
    out = ordered.state_run_length(df, ["k"], ["t"], ["s"]).orderBy("t")
    assert [r.run for r in out.collect()] == [0, 1, 0, 1, 2, 0, 0, 1]


def test_nonzero_run_by_hand(spark):
    flags = [0, 1, 2, None, 1, 1, 0, 1]
    df = spark.createDataFrame([(1, i, f) for i, f in enumerate(flags)], "k int, t int, f int")
    out = ordered.nonzero_run(df, ["k"], ["t"], "f").orderBy("t")
    assert [r.run for r in out.collect()] == [0, 1, 2, 0, 1, 2, 0, 1]


def test_interpolation_edges(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, 1.0), (1, 5, None), (1, 9, 5.0), (1, 10, None), (2, 0, None)], "k int, t int, v double")
    equal = {(r.k, r.t): r.v for r in ordered.interpolate(df, ["k"], "t", "v").collect()}
    assert equal == {(1, 0): None, (1, 1): 1.0, (1, 5): 3.0, (1, 9): 5.0, (1, 10): 5.0, (2, 0): None}
    timed = ordered.interpolate(df.withColumn("t", F.when(F.col("t") == 5, 3).otherwise(F.col("t"))), ["k"], "t", "v", by_time=True)
    assert {r.t: r.v for r in timed.filter("k = 1").collect()}[3] == 2.0


def test_quantiles_match_sorting(spark):
    rng = random.Random(1)
    rows = [(i % 3, rng.choice([float("nan"), None, rng.random(), 0.5])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v double")
    probs = {"lo": 0.0, "q": 0.3, "hi": 1.0}
    for parts in (1, 20):
        got = {r.k: (r.lo, r.q, r.hi) for r in ordered.quantiles(df, ["k"], "v", probs, parts).collect()}
        for k in range(3):
            values = sorted(v for key, v in rows if key == k and v is not None and v == v)
            spot = (len(values) - 1) * 0.3
            low = int(spot)
            want = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (spot - low)
            assert got[k][0] == values[0] and got[k][2] == values[-1] and abs(got[k][1] - want) < 1e-12


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert ordered.quantiles(df, [], "v", {"m": 0.5}).count() == 0
    assert ordered.quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_quartile_bins_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "v double")
    out = ordered.quantile_bins(df, "v", [0.0, 0.25, 0.5, 0.75]).orderBy("v")
    assert [r.bin for r in out.collect()] == [1, 1, 2, 3, 4]


def test_folds(spark):
    out = ordered.fold(spark.range(10), ["id"], 4).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in out] == [3, 3, 2, 2]
    assert ordered.fold(spark.range(2), ["id"], 4).select("fold").distinct().count() == 2


def test_interval_ends(spark):
    def at(h):
        return datetime(2024, 1, 1, h)

    rows = spark.createDataFrame([("a", at(h)) for h in range(6)] + [("b", at(2))], "k string, ts timestamp")
    iv = spark.createDataFrame(
        [("a", at(1), at(3), False), ("a", at(2), at(3), False), ("a", at(3), at(5), True), ("a", at(4), at(4), False)],
        "k string, s timestamp, e timestamp, open_start boolean",
    )
    out = ordered.covered(rows, iv, ["k"], "ts").orderBy("k", "ts").collect()
    assert [r.covered for r in out] == [0, 1, 1, 0, 1, 0, 0]


def test_top_and_latest(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 9, "z"), (2, 1, "w")], "k int, v int, n string")
    top = ordered.top_k(df, ["k"], [F.col("v").desc(), F.col("n")], 2)
    assert sorted((r.k, r.n, r["rank"]) for r in top.collect()) == [(1, "x", 2), (1, "z", 1), (2, "w", 1)]
    assert sorted((r.k, r.n) for r in ordered.latest(df, ["k"], ["v", "n"]).collect()) == [(1, "z"), (2, "w")]


def test_prior_mean_ignores_the_same_order(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 9.0), ("b", 1, 1.0), (None, 1, 5.0), (None, 2, 0.0)], "k string, c int, v double")
    out = {(r.k, r.c, r.v): r.prior for r in ordered.prior_mean(df, ["k"], "c", "v").collect()}
    assert out == {("a", 1, 2.0): 0.0, ("a", 1, 4.0): 0.0, ("a", 2, 9.0): 3.0, ("b", 1, 1.0): 0.0, (None, 1, 5.0): 0.0, (None, 2, 0.0): 5.0}
