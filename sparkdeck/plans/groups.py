"""Aggregations, ordered operators, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..functions.scalar import right_closed
from ..operators import ordered, relational as rel, stats
from .registry import query


def rows_n():
    return F.count(F.lit(1)).alias("n")


@query("d01_row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return t.lineitem.agg(rows_n())


@query(
    "d02_global_sums",
    """SELECT round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price,
              CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem""",
)
def global_sums(t):
    return t.lineitem.agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.sum("l_linenumber").alias("lines"),
    )


@query(
    "d03_word_count",
    """SELECT word, count(*) AS n FROM (
         SELECT unnest(string_split(lower(regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g')), ' ')) AS word FROM documents)
       WHERE word <> '' GROUP BY word""",
)
def word_count(t):
    return rel.word_counts(t.documents, F.split(F.lower(text.strip_punctuation(F.col("text"))), " "))


@query(
    "d04_word_count_any_case",
    """SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\x0B]+')) AS word
       FROM documents) WHERE word <> '' GROUP BY word""",
)
def word_count_any_case(t):
    return rel.word_counts(t.documents, F.split(F.lower("text"), r"\s+"))


@query(
    "d05_extremes_and_distinct",
    """SELECT l_suppkey, max(l_quantity) AS hi, min(l_quantity) AS lo, count(DISTINCT l_partkey) AS parts
       FROM lineitem GROUP BY l_suppkey""",
)
def extremes_and_distinct(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.count_distinct("l_partkey").alias("parts")
    )


@query("d06_most_active", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10")
def most_active(t):
    return t.events.groupBy("user_id").agg(rows_n()).orderBy(F.col("n").desc(), "user_id").limit(10)


@query(
    "d07_mean_by_key_min_count",
    """SELECT l_suppkey, l_linenumber, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 30""",
)
def mean_by_key_min_count(t):
    out = rel.mean_by_key(t.lineitem, ["l_suppkey", "l_linenumber"], "l_quantity", 30)
    return out.withColumn("mean", F.round("mean", 6))


@query(
    "d08_values_per_key",
    "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id",
)
def values_per_key(t):
    # event types are a short fixed vocabulary, so the set per user is bounded
    kinds = F.array_join(F.sort_array(F.collect_set("event_type")), ",")
    return t.events.groupBy("user_id").agg(kinds.alias("kinds"))


@query(
    "d09_filtered_sum",
    """SELECT concat_ws('-', l_suppkey, l_linenumber) AS code, CAST(sum(l_quantity) AS BIGINT) AS qty
       FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def filtered_sum(t):
    kept = t.lineitem.filter("l_returnflag = 'R'")
    per = kept.groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    return per.select(F.concat_ws("-", "l_suppkey", "l_linenumber").alias("code"), "qty")


_ITEM_MEAN = "SELECT rating, avg(rating) OVER (PARTITION BY item_id) AS pred FROM v_ratings"


def with_item_mean(t):
    means = t.v_ratings.groupBy("item_id").agg(F.avg("rating").alias("pred"))
    return t.v_ratings.join(means, "item_id")


@query(
    "d10_mean_squared_error",
    f"""SELECT round(avg(pow(rating - pred, 2)), 6) AS mse, round(sqrt(avg(pow(rating - pred, 2))), 6) AS rmse,
               count(*) AS n FROM ({_ITEM_MEAN})""",
)
def mean_squared_error(t):
    out = stats.rmse(with_item_mean(t), "rating", "pred")
    return out.select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"), "n")


@query(
    "d11_error_rate",
    "SELECT round(avg(CASE WHEN quality <> toxic THEN 1.0 ELSE 0.0 END), 6) AS error, count(*) AS n FROM labels",
)
def error_rate(t):
    return stats.error_rate(t.labels, "quality", "toxic").withColumn("error", F.round("error", 6))


_NDVI = "SELECT *, CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END AS ndvi FROM v_pixels"


@query(
    "d12_fixed_classes",
    f"""SELECT CASE WHEN ndvi <= 0 THEN 0 WHEN ndvi <= 0.1 THEN 1 WHEN ndvi <= 0.2 THEN 2 WHEN ndvi <= 0.3 THEN 3
               WHEN ndvi <= 0.4 THEN 4 WHEN ndvi <= 0.5 THEN 5 WHEN ndvi <= 0.6 THEN 6 WHEN ndvi <= 0.7 THEN 7
               ELSE 8 END AS class, count(*) AS n FROM ({_NDVI}) WHERE ndvi IS NOT NULL GROUP BY 1""",
)
def fixed_classes(t):
    total = F.col("nir") + F.col("red")
    value = F.when(total != 0, (F.col("nir") - F.col("red")) / total)
    cls = right_closed(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7])
    return t.v_pixels.select(cls.alias("class")).filter("class IS NOT NULL").groupBy("class").agg(rows_n())


@query(
    "d13_normalised_histogram",
    """SELECT CAST(b AS BIGINT) AS bin, round(coalesce(n, 0) / (SELECT count(*) FROM events), 8) AS frac
       FROM (SELECT unnest(range(0, 20)) AS b) LEFT JOIN
       (SELECT CASE WHEN value = 50 THEN 19 ELSE CAST(floor(value / 2.5) AS BIGINT) END AS v, count(*) AS n FROM events
        WHERE value BETWEEN 0 AND 50 GROUP BY 1) ON v = b""",
)
def normalised_histogram(t):
    return rel.histogram(t.events, "value", 0.0, 50.0, 20).withColumn("frac", F.round("frac", 8))


@query(
    "d14_histogram_by_class",
    """SELECT event_type, CAST(b AS BIGINT) AS bin, round(coalesce(n, 0) / total, 8) AS frac FROM
         (SELECT event_type, count(*) AS total FROM events GROUP BY 1), (SELECT unnest(range(0, 10)) AS b)
         LEFT JOIN (SELECT event_type AS e, CASE WHEN value = 50 THEN 9 ELSE CAST(floor(value / 5) AS BIGINT) END AS v,
                    count(*) AS n FROM events WHERE value BETWEEN 0 AND 50 GROUP BY 1, 2) ON v = b AND e = event_type""",
)
def histogram_by_class(t):
    out = rel.histogram(t.events, "value", 0.0, 50.0, 10, ["event_type"])
    return out.withColumn("frac", F.round("frac", 8))


@query("d15_cells_per_tile", "SELECT tile_col, tile_row, count(*) AS n FROM v_pixels GROUP BY 1, 2")
def cells_per_tile(t):
    return t.v_pixels.groupBy("tile_col", "tile_row").agg(rows_n())


@query("d16_count_distinct", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def count_distinct(t):
    return rel.n_distinct(t.lineitem, "l_partkey")


@query("d17_value_counts", "SELECT p_size, count(*) AS n FROM part GROUP BY 1")
def value_counts(t):
    return t.part.groupBy("p_size").agg(rows_n())


@query(
    "d18_missing_counts",
    """SELECT 'flag' AS name, count(*) - count(flag) AS missing, count(flag) AS present FROM v_sensor UNION ALL
       SELECT 'state_b', count(*) - count(state_b), count(state_b) FROM v_sensor""",
)
def missing_counts(t):
    return rel.missing_counts(t.v_sensor, ["flag", "state_b"])


@query("d19_contingency", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def contingency(t):
    return rel.contingency(t.labels, "quality", "toxic")


@query(
    "d20_group_totals",
    "SELECT c_nationkey, round(sum(c_acctbal), 2) AS total, count(*) AS n FROM customer GROUP BY 1",
)
def group_totals(t):
    return t.customer.groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("total"), rows_n())


@query(
    "d21_spread_by_group",
    """SELECT tile_col, tile_row, min(nir) AS lo, max(nir) AS hi, round(avg(nir), 6) AS mean,
              round(stddev_pop(nir), 6) AS std FROM v_pixels GROUP BY 1, 2""",
)
def spread_by_group(t):
    return t.v_pixels.groupBy("tile_col", "tile_row").agg(
        F.min("nir").alias("lo"), F.max("nir").alias("hi"), F.round(F.avg("nir"), 6).alias("mean"),
        F.round(F.stddev_pop("nir"), 6).alias("std"),
    )


@query(
    "d22_median_by_group",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median, min(l_extendedprice) AS lo,
              max(l_extendedprice) AS hi FROM lineitem GROUP BY 1, 2""",
)
def median_by_group(t):
    key = ["l_returnflag", "l_linestatus"]
    mid = ordered.quantiles(t.lineitem, key, "l_extendedprice", {"median": 0.5})
    ends = t.lineitem.groupBy(*key).agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))
    return mid.withColumn("median", F.round("median", 4)).join(ends, key)


@query(
    "e01_state_run_length",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) - 1 AS run FROM (
         SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM (
           SELECT *, CASE WHEN state_a = lag(state_a) OVER w AND state_b = lag(state_b) OVER w THEN 0 ELSE 1 END AS changed
           FROM v_sensor WINDOW w AS (PARTITION BY user_id ORDER BY event_id)))""",
)
def state_run_length(t):
    out = ordered.state_run_length(t.v_sensor, ["user_id"], ["event_id"], ["state_a", "state_b"])
    return out.select("event_id", "run")


@query(
    "e02_nonzero_run",
    """SELECT event_id, CASE WHEN coalesce(flag, 0) = 0 THEN 0 ELSE
         row_number() OVER (PARTITION BY user_id, z ORDER BY event_id) - CASE WHEN z = 0 THEN 0 ELSE 1 END END AS run
       FROM (SELECT *, sum(CASE WHEN coalesce(flag, 0) = 0 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY event_id) AS z FROM v_sensor)""",
)
def nonzero_run(t):
    return ordered.nonzero_run(t.v_sensor, ["user_id"], ["event_id"], "flag").select("event_id", "run")


_RETURNS = """SELECT asset, month, (price - lag(price) OVER w) / lag(price) OVER w AS ret FROM v_monthly
              WINDOW w AS (PARTITION BY asset ORDER BY month)"""


@query("e03_period_return", f"SELECT asset, month, round(ret, 8) AS ret FROM ({_RETURNS})")
def period_return(t):
    out = ordered.period_return(t.v_monthly, ["asset"], ["month"], "price")
    return out.select("asset", "month", F.round("ret", 8).alias("ret"))


@query(
    "e04_top_per_key",
    """SELECT l_suppkey, l_partkey, l_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
         ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 4""",
)
def top_per_key(t):
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    return ordered.top_k(t.lineitem, ["l_suppkey"], order, 4).select("l_suppkey", "l_partkey", "l_orderkey", "rank")


@query(
    "e05_running_total",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS total FROM events""",
)
def running_total(t):
    rows = t.events.select("event_id", "user_id", "value")
    out = ordered.running_sum(rows, ["user_id"], ["event_id"], "value", "total")
    return out.select("event_id", "user_id", F.round("total", 2).alias("total"))


@query(
    "e07_quartile_bins",
    """SELECT p_partkey, CASE WHEN p_retailprice <= q1 THEN 1 WHEN p_retailprice <= q2 THEN 2
              WHEN p_retailprice <= q3 THEN 3 ELSE 4 END AS bin
       FROM part, (SELECT quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS q2,
                          quantile_cont(p_retailprice, 0.75) AS q3 FROM part)""",
)
def quartile_bins(t):
    out = ordered.quantile_bins(t.part, "p_retailprice", [0.0, 0.25, 0.5, 0.75])
    return out.select("p_partkey", "bin")


@query(
    "e08_top_terms_per_bucket",
    """SELECT bucket, term, n FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY term DESC) AS r FROM (
         SELECT strftime(ts, '%Y-%m-%d %H:00') AS bucket, event_type AS term, count(*) AS n FROM events GROUP BY 1, 2))
       WHERE r <= 3""",
)
def top_terms_per_bucket(t):
    bucket = F.date_format("ts", "yyyy-MM-dd HH:00")
    n = t.events.groupBy(bucket.alias("bucket"), F.col("event_type").alias("term")).agg(rows_n())
    return ordered.top_k(n, ["bucket"], [F.col("term").desc()], 3).select("bucket", "term", "n")


@query(
    "e09_latest_per_key",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def latest_per_key(t):
    rows = t.events.select("user_id", "event_id", "event_type")
    return ordered.latest(rows, ["user_id"], ["event_id"])


@query(
    "f01_sort_with_nulls_first",
    "SELECT event_id, flag, row_number() OVER (ORDER BY flag ASC NULLS FIRST, event_id) AS pos FROM v_sensor",
)
def sort_with_nulls_first(t):
    return ordered.row_index(t.v_sensor.select("event_id", "flag"), [], ["flag", "event_id"], "pos")


@query(
    "f02_global_top",
    """SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1
       ORDER BY sum(l_extendedprice) DESC, l_partkey LIMIT 15""",
)
def global_top(t):
    revenue = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("revenue"))
    return revenue.orderBy(F.col("revenue").desc(), "l_partkey").limit(15).withColumn("revenue", F.round("revenue", 2))


@query(
    "f03_sorted_list_per_key",
    """SELECT l_suppkey, string_agg(l_partkey, ',' ORDER BY rank) AS parts FROM (
         SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC, l_partkey) AS rank FROM (
           SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)) WHERE rank <= 5 GROUP BY 1""",
)
def sorted_list_per_key(t):
    q = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    top = ordered.top_k(q, ["l_suppkey"], [F.col("q").desc(), F.col("l_partkey")], 5)
    listed = F.sort_array(F.collect_list(F.struct("rank", "l_partkey")))
    parts = F.array_join(F.transform(listed, lambda s: s["l_partkey"].cast("string")), ",")
    return top.groupBy("l_suppkey").agg(parts.alias("parts"))


@query(
    "f05_numbers_held_as_text",
    """SELECT k, n, row_number() OVER (ORDER BY CAST(k AS BIGINT)) AS pos
       FROM (SELECT CAST(user_id AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1)""",
)
def numbers_held_as_text(t):
    n = t.events.groupBy(F.col("user_id").cast("string").alias("k")).agg(rows_n())
    numbered = n.withColumn("_number", F.col("k").cast("bigint"))
    return ordered.row_index(numbered, [], ["_number"], "pos").drop("_number")
