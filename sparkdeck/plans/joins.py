"""Joins, unions and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as rel
from ..operators.ordered import covered, prior_mean
from ..operators.spatial import distances_to
from ..session import stored
from .registry import query


@query(
    "c01_inner_join",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(t):
    o, c = t.orders, t.customer
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


@query(
    "c02_item_rating_range",
    """SELECT p_partkey, p_name, max_rating, min_rating, users FROM (
         SELECT item_id, max(rating) AS max_rating, min(rating) AS min_rating, count(DISTINCT user_id) AS users
         FROM v_ratings GROUP BY item_id) JOIN part ON item_id = p_partkey""",
)
def item_rating_range(t):
    # the view has one row per user and item, so the users of an item are distinct
    per_item = t.v_ratings.groupBy("item_id").agg(
        F.max("rating").alias("max_rating"), F.min("rating").alias("min_rating"), F.count("user_id").alias("users")
    )
    named = per_item.join(t.part, F.col("item_id") == F.col("p_partkey"))
    return named.select("p_partkey", "p_name", "max_rating", "min_rating", "users")


@query(
    "c03_composite_key_join",
    """SELECT user_id, item_id, rating, n FROM v_ratings JOIN
       (SELECT o_custkey AS user_id, l_partkey AS item_id, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY 1, 2) USING (user_id, item_id)""",
)
def composite_key_join(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    bought = lines.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return t.v_ratings.join(bought, ["user_id", "item_id"]).select("user_id", "item_id", "rating", "n")


@query(
    "c04_left_join_default",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN
       (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def left_join_default(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "c05_remove_present_pairs",
    """SELECT user_id, item_id FROM v_ratings r WHERE NOT EXISTS
       (SELECT 1 FROM v_ratings p WHERE p.rating >= 4 AND p.user_id = r.user_id AND p.item_id = r.item_id)""",
)
def remove_present_pairs(t):
    done = t.v_ratings.filter("rating >= 4").select("user_id", "item_id")
    return t.v_ratings.join(done, ["user_id", "item_id"], "left_anti").select("user_id", "item_id")


@query(
    "c06_keep_known_keys",
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def keep_known_keys(t):
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return t.events.select("event_id", "user_id").join(known, "user_id", "left_semi").select("event_id", "user_id")


@query(
    "c07_dictionary_lookup",
    "SELECT s_suppkey, coalesce(n_name, '?') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
)
def dictionary_lookup(t):
    dim = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    return rel.lookup(t.supplier, dim, "s_nationkey", "n_name", "?", "nation").select("s_suppkey", "nation")


# Places that points are measured against.
PLACES = [("north", 35.0, -112.0), ("south", 31.0, -110.0), ("east", 33.0, -107.0)]


def _km_sql(lat, lon):
    return f"""2 * 6372.8 * asin(sqrt(least(1.0, pow(sin(radians({lat} - lat) / 2), 2)
        + cos(radians(lat)) * cos(radians({lat})) * pow(sin(radians({lon} - lon) / 2), 2))))"""


@query(
    "c09_distances_to_places",
    " UNION ALL ".join(
        f"SELECT event_id, '{n}' AS place, round({_km_sql(a, o)}, 4) AS km FROM v_points" for n, a, o in PLACES
    ),
)
def distances_to_places(t):
    out = distances_to(t.v_points, "lat", "lon", PLACES)
    return out.select("event_id", "place", F.round("km", 4).alias("km"))


@query(
    "c10_tile_index_join",
    """SELECT a.tile_col, a.tile_row, a.n AS n_first, b.n AS n_second, m FROM
       (SELECT tile_col, tile_row, count(*) AS n FROM v_pixels GROUP BY 1, 2) a JOIN
       (SELECT tile_col, tile_row, count(*) AS n FROM v_pixels2 GROUP BY 1, 2) b USING (tile_col, tile_row) JOIN
       (SELECT tile_col, tile_row, max(nir) AS m FROM v_pixels GROUP BY 1, 2) c USING (tile_col, tile_row)""",
)
def tile_index_join(t):
    key = ["tile_col", "tile_row"]
    a = t.v_pixels.groupBy(*key).agg(F.count(F.lit(1)).alias("n_first"), F.max("nir").alias("m"))
    b = t.v_pixels2.groupBy(*key).agg(F.count(F.lit(1)).alias("n_second"))
    return a.join(b, key)


@query(
    "c11_pixel_join",
    """SELECT a.x, a.y, a.red AS red_1, b.red AS red_2 FROM v_pixels a JOIN v_pixels2 b ON a.x = b.x AND a.y = b.y""",
)
def pixel_join(t):
    a = t.v_pixels.select("x", "y", F.col("red").alias("red_1"))
    return a.join(t.v_pixels2.select("x", "y", F.col("red").alias("red_2")), ["x", "y"])


@query(
    "c12_interval_label",
    """SELECT event_id, event_type, CAST(EXISTS (SELECT 1 FROM v_intervals i WHERE i.event_type = ev.event_type
          AND (CASE WHEN i.open_start THEN ev.ts > i.s ELSE ev.ts >= i.s END) AND ev.ts < i.e) AS INTEGER) AS danger
       FROM events ev""",
)
def interval_label(t):
    rows = t.events.select("event_id", "event_type", "ts")
    return covered(rows, t.v_intervals, ["event_type"], "ts", "danger").drop("ts")


def _prior_sql(keys, out):
    on = " AND ".join(f"p.{k} = a.{k}" for k in keys)
    return f"""SELECT article, collection, colour, family, age,
        round(coalesce((SELECT avg(qty) FROM v_articles p WHERE {on} AND p.collection < a.collection), 0), 6) AS {out}
        FROM v_articles a"""


@query("c13_prior_mean_by_code", _prior_sql(["article"], "ref"))
def prior_mean_by_code(t):
    out = prior_mean(stored(t.v_articles, "articles"), ["article"], "collection", "qty", out="ref")
    return out.withColumn("ref", F.round("ref", 6)).drop("qty")


@query("c14_prior_mean_by_attributes", _prior_sql(["colour", "family", "age"], "ref"))
def prior_mean_by_attributes(t):
    out = prior_mean(stored(t.v_articles, "articles"), ["colour", "family", "age"], "collection", "qty", out="ref")
    return out.withColumn("ref", F.round("ref", 6)).drop("qty")


@query(
    "c15_names_for_both_sides",
    """SELECT o_orderkey, l_partkey, c_name AS buyer, p_name AS item FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""",
)
def names_for_both_sides(t):
    pairs = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").join(
        t.orders.select("o_orderkey", "o_custkey"), "o_orderkey"
    )
    buyers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("buyer"))
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item"))
    return pairs.join(buyers, "o_custkey").join(items, "l_partkey").select("o_orderkey", "l_partkey", "buyer", "item")


@query("g01_union", "SELECT s_nationkey AS k FROM supplier UNION ALL SELECT c_nationkey FROM customer")
def union(t):
    return rel.union_all([t.supplier.select(F.col("s_nationkey").alias("k")), t.customer.select(F.col("c_nationkey").alias("k"))])


@query("g02_union_of_bands", "SELECT band, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM v_bands GROUP BY band")
def union_of_bands(t):
    p = t.v_pixels
    third = F.pmod(F.col("red") + F.col("nir"), F.lit(10007.0))
    parts = [
        p.select("x", F.lit("B4").alias("band"), F.col("red").alias("value")),
        p.select("x", F.lit("B5").alias("band"), F.col("nir").alias("value")),
        p.select("x", F.lit("B3").alias("band"), third.alias("value")),
    ]
    return rel.union_all(parts).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("total")
    )


@query(
    "g03_append_campaigns",
    """SELECT conv_id, role, turn FROM conversations UNION ALL SELECT conv_id + 10, role, NULL FROM conversations""",
)
def append_campaigns(t):
    first = t.conversations.select("conv_id", "role", "turn")
    second = first.drop("turn").withColumn("conv_id", F.col("conv_id") + 10)
    return rel.union_all([first, second], allow_missing=True)


@query(
    "g04_zero_filled_counts",
    """SELECT b AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(range(0, 60)) AS b) LEFT JOIN
       (SELECT CAST(floor(value) AS BIGINT) AS v, count(*) AS n FROM events GROUP BY 1) ON v = b""",
)
def zero_filled_counts(t):
    bins = t.spark.range(60).withColumnRenamed("id", "bin")
    n = t.events.groupBy(F.floor("value").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(n, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
