"""User functions as column expressions and aggregates: row lambdas, accumulators, group procedures."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query


@query(
    "j01_row_lambda",
    """SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda w: length(w) > 3),
         lambda w: upper(w)), '-') AS label FROM part""",
)
def row_lambda(t):
    long_words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 3)
    return t.part.select("p_partkey", F.array_join(F.transform(long_words, F.upper), "-").alias("label"))


@query(
    "j03_accumulator_by_key",
    """SELECT user_id, event_type, round(exp(avg(ln(value))), 6) AS geometric_mean FROM events WHERE value > 0 GROUP BY 1, 2""",
)
def accumulator_by_key(t):
    # the (sum, count) pair of a hand-written accumulator is what avg merges map-side
    kept = t.events.filter("value > 0").groupBy("user_id", "event_type")
    return kept.agg(F.round(F.exp(F.avg(F.log("value"))), 6).alias("geometric_mean"))


@query(
    "j04_group_procedure",
    """SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem GROUP BY 1""",
)
def group_procedure(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("intercept"),
    )


@query(
    "j05_row_to_rows",
    """SELECT step, count(*) AS n FROM (SELECT unnest(range(1, CAST(l_linenumber AS BIGINT) + 1)) AS step FROM lineitem) GROUP BY 1""",
)
def row_to_rows(t):
    steps = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("l_linenumber").cast("bigint"))).alias("step")
    return t.lineitem.select(steps).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
