"""Projection, predicates, recoding, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import score_band
from ..operators import relational as rel
from ..operators.ordered import fold, row_index
from .registry import query


@query("b01_select_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def select_columns(t):
    return t.customer.select("c_custkey", "c_mktsegment")


@query(
    "b02_compare_filters",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_linenumber = 1 AND l_returnflag <> 'N'",
)
def compare_filters(t):
    kept = t.lineitem.filter("l_quantity > 45 AND l_linenumber = 1 AND l_returnflag != 'N'")
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "b03_or_and_filters",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE (o_orderstatus = 'F' OR o_totalprice > 400000) AND o_custkey < 500""",
)
def or_and_filters(t):
    either = (F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 400000)
    return t.orders.filter(either & (F.col("o_custkey") < 500)).select("o_orderkey", "o_orderstatus")


@query(
    "b04_sql_over_views",
    """SELECT c_mktsegment, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey
       WHERE o_totalprice > 100000 GROUP BY c_mktsegment""",
)
def sql_over_views(t):
    return t.sql(
        """SELECT c_mktsegment, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey
           WHERE o_totalprice > 100000 GROUP BY c_mktsegment"""
    )


@query("b05_substring_filter", "SELECT doc_id FROM documents WHERE contains(text, 'ation')")
def substring_filter(t):
    return t.documents.filter(F.col("text").contains("ation")).select("doc_id")


@query("b06_membership", "SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'es')")
def membership(t):
    return t.documents.filter(F.col("lang").isin("fr", "es")).select("doc_id", "lang")


@query(
    "b07_row_validation",
    """SELECT event_id, f[4] AS answer, f[10] AS email FROM (SELECT event_id, string_split(line, chr(9)) AS f FROM v_tsv)
       WHERE len(f) = 18 AND NOT regexp_full_match(f[10], '.*@staff\\.example')""",
)
def row_validation(t):
    f = F.split("line", "\t")
    rows = t.v_tsv.select("event_id", f.alias("f")).filter(
        (F.size("f") == 18) & ~F.col("f")[9].rlike(r"^.*@staff\.example$")
    )
    return rows.select("event_id", F.col("f")[3].alias("answer"), F.col("f")[9].alias("email"))


@query(
    "b08_add_and_cast",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS qty,
              round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem""",
)
def add_and_cast(t):
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    rows = t.lineitem.withColumns({"qty": F.col("l_quantity").cast("int"), "net": net})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "qty", "net")


@query("b09_rename", "SELECT s_suppkey AS id, s_name AS label FROM supplier")
def rename(t):
    return t.supplier.withColumnsRenamed({"s_suppkey": "id", "s_name": "label"}).select("id", "label")


@query("b10_drop_columns", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def drop_columns(t):
    return t.part.drop("p_type")


@query(
    "b11_recode_cases",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' ELSE 'low' END AS urgency FROM orders""",
)
def recode_cases(t):
    p = F.col("o_orderpriority")
    urgency = F.when(p.isin("1-URGENT", "2-HIGH"), "high").when(p == "3-MEDIUM", "medium").otherwise("low")
    return t.orders.select("o_orderkey", urgency.alias("urgency"))


# Lower bounds and names of the five score bands.
BAND_BOUNDS = [0.8, 0.6, 0.4, 0.2]
BAND_NAMES = ["Positif", "Moyennement positif", "Neutre", "Moyennement negatif", "Negatif"]


@query(
    "b12_score_bands",
    """SELECT event_id, CASE WHEN s >= 0.8 THEN 'Positif' WHEN s >= 0.6 THEN 'Moyennement positif'
              WHEN s >= 0.4 THEN 'Neutre' WHEN s >= 0.2 THEN 'Moyennement negatif' ELSE 'Negatif' END AS band
       FROM (SELECT event_id, value / 100 AS s FROM events)""",
)
def score_bands(t):
    return t.events.select("event_id", score_band(F.col("value") / 100, BAND_BOUNDS, BAND_NAMES).alias("band"))


@query(
    "b13_fill_by_type",
    "SELECT event_id, coalesce(flag, 0) AS flag, coalesce(label, '-') AS label FROM "
    "(SELECT event_id, flag, CASE WHEN state_b = 1 THEN 'on' END AS label FROM v_sensor)",
)
def fill_by_type(t):
    rows = t.v_sensor.select("event_id", "flag", F.when(F.col("state_b") == 1, "on").alias("label"))
    return rel.fill_by_type(rows)


@query(
    "b14_unknown_to_other",
    """SELECT p_partkey, coalesce(r_name, 'other') AS label FROM part LEFT JOIN region ON p_size = r_regionkey""",
)
def unknown_to_other(t):
    dim = t.region.withColumnRenamed("r_regionkey", "p_size")
    return rel.lookup(t.part, dim, "p_size", "r_name", "other", "label").select("p_partkey", "label")


@query("b15_drop_rows_with_null", "SELECT event_id FROM v_sensor WHERE flag IS NOT NULL AND state_b IS NOT NULL")
def drop_rows_with_null(t):
    return t.v_sensor.dropna("any").select("event_id")


@query("b16_keep_when_unknown", "SELECT event_id, flag FROM v_sensor WHERE coalesce(flag <> 2, true)")
def keep_when_unknown(t):
    return t.v_sensor.filter(F.coalesce(F.col("flag") != 2, F.lit(True))).select("event_id", "flag")


@query(
    "b17_field_default",
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-1') AS k,
              coalesce(json_extract_string(props, '$.missing'), 'none') AS missing FROM events""",
)
def field_default(t):
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("-1"))
    missing = F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none"))
    return t.events.select("event_id", k.alias("k"), missing.alias("missing"))


@query("b18_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("b19_take_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def take_n(t):
    return t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("b20_random_split", "SELECT count(*) AS n, 0 AS overlap FROM orders")
def random_split(t):
    a, b, c = rel.split_by_hash(t.orders.select("o_orderkey"), "o_orderkey", [0.7, 0.15, 0.15], seed=7)
    tagged = rel.union_all([p.withColumn("part", F.lit(i)) for i, p in enumerate((a, b, c))])
    per = tagged.groupBy("o_orderkey").agg(F.count_distinct("part").alias("parts"))
    return per.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("parts") > 1, 1).otherwise(0)).cast("int").alias("overlap")
    )


@query("b21_subsample", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def subsample(t):
    """Ten samples at growing rates: an order's lines are in all samples from some rate on, and in the last one."""
    rows = t.lineitem.select("l_orderkey")
    first = F.min("rate")
    grown = rel.union_all([rel.sample_by_hash(rows, "l_orderkey", r / 10, seed=3).withColumn("rate", F.lit(r)) for r in range(1, 11)])
    per = grown.groupBy("l_orderkey", "rate").agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("l_orderkey").agg(first.alias("first"), F.count(F.lit(1)).alias("rates"), F.min("n").alias("low"), F.max("n").alias("high"))
    nested = (F.col("first") + F.col("rates") == 11) & (F.col("low") == F.col("high"))
    return per.select("l_orderkey", F.when(nested, F.col("high")).alias("n"))


@query("b21_subsample_share", "SELECT count(*) AS n, true AS near_rate, true AS nested FROM lineitem")
def subsample_share(t):
    rows = t.lineitem.select("l_orderkey")
    small, large = (rel.sample_by_hash(rows, "l_orderkey", r, seed=3) for r in (0.2, 0.5))
    tagged = rel.union_all([d.withColumn("part", F.lit(i)) for i, d in enumerate((rows, small, large, small.join(large.distinct(), "l_orderkey", "left_semi")))])
    n = [F.count(F.when(F.col("part") == i, 1)) for i in range(4)]
    near = (n[1] / n[0]).between(0.15, 0.25) & (n[2] / n[0]).between(0.45, 0.55)
    return tagged.agg(n[0].alias("n"), near.alias("near_rate"), (n[1] == n[3]).alias("nested"))


@query(
    "b22_hold_out_groups",
    """SELECT lang, sum(CASE WHEN source IN ('src0', 'src1') THEN 0 ELSE 1 END)::BIGINT AS train,
              sum(CASE WHEN source IN ('src0', 'src1') THEN 1 ELSE 0 END)::BIGINT AS test
       FROM documents GROUP BY lang""",
)
def hold_out_groups(t):
    held = t.documents.select("source").filter(F.col("source").isin("src0", "src1"))
    train, test = rel.split_by_key(t.documents.select("doc_id", "lang", "source"), held, ["source"])
    both = rel.union_all([train.withColumn("test", F.lit(0)), test.withColumn("test", F.lit(1))])
    return both.groupBy("lang").agg(F.sum(1 - F.col("test")).alias("train"), F.sum("test").alias("test"))


@query("b23_contiguous_folds", "SELECT p_partkey, CAST(ntile(4) OVER (ORDER BY p_partkey) AS INTEGER) AS fold FROM part")
def contiguous_folds(t):
    return fold(t.part.select("p_partkey"), ["p_partkey"], 4)


@query("b25_dense_row_index", "SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS idx FROM supplier")
def dense_row_index(t):
    return row_index(t.supplier.select("s_suppkey"), [], ["s_suppkey"])


@query(
    "b26_conditional_cells",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber IN (1, 3) THEN 1 ELSE 0 END AS a,
              CASE WHEN l_quantity IN (1, 3) THEN 1 ELSE 0 END AS b FROM lineitem""",
)
def conditional_cells(t):
    def recode(c):
        return F.when(F.col(c).isin(1, 3), 1).otherwise(0)

    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", recode("l_linenumber").alias("a"), recode("l_quantity").alias("b")
    )
