"""Shape of the physical plans."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

from sparkdeck.operators import features, ordered, spatial
from sparkdeck.plans import QUERIES, learn
from sparkdeck.plans.views import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SCALAR_ONLY = {"b23_contiguous_folds"}

EXACT = {n for n in QUERIES if n[0] in "bcdefghkop" and n not in SCALAR_ONLY}


# the factor model of the library multiplies blocks of user and item factors
BY_LIBRARY = {"n04_items_for_one_user", "n05_items_for_all_users"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_and_no_python_rows(spark, sf_dir, name):
    """All entries are free of cross joins, exact ones of Python as well."""
    text = plan(QUERIES[name](spark, sf_dir))
    assert name in BY_LIBRARY or "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name in EXACT:
        assert "PythonUDF" not in text and "InPandas" not in text


def test_median_takes_one_shuffle(spark, sf_dir):
    assert plan(QUERIES["o22_median_filter"](spark, sf_dir)).count("Exchange hashpartitioning") == 1


def test_newsletter_scores_only_who_is_mailed():
    assert "recommend.mailed" in inspect.getsource(learn.newsletter_rows)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    text = plan(spatial.in_rectangle(t.part.select(F.col("p_retailprice").alias("a"), "p_size"), "a", "p_size", (900.0, 901.0, 1, 9)))
    assert "GreaterThanOrEqual(p_retailprice,900.0)" in text
    assert re.search(r"ReadSchema: struct<p_size:int,p_retailprice:double>", text)


def test_top_k_prunes_before_the_shuffle(spark, sf_dir):
    t = Tables(spark, sf_dir)
    text = plan(ordered.top_k(t.lineitem, ["l_suppkey"], [F.col("l_extendedprice").desc()], 3))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_latest_combines_before_the_shuffle(spark, sf_dir):
    t = Tables(spark, sf_dir)
    assert "partial_max_by" in plan(ordered.latest(t.events, ["user_id"], ["event_id"]))


def test_knn_needs_no_shuffle(spark, sf_dir):
    text = plan(QUERIES["p03_nearest_points"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_rating_range_aggregates_pairs_once(spark, sf_dir):
    assert "distinct" not in plan(QUERIES["c02_item_rating_range"](spark, sf_dir))


def test_tf_idf_does_not_sort_the_counts(spark, sf_dir):
    assert "SortMergeJoin" not in plan(QUERIES["l07_tf_idf"](spark, sf_dir))


def test_sum_of_a_sparse_vector_reads_its_entries(spark):
    rows = spark.createDataFrame([(["a", "b", "a"],), ([],)], "w array<string>")
    sums = features.hashed_counts(rows, "w", 1 << 15).select(features.total("tf").alias("n"))
    assert "vector_to_array" not in plan(sums).lower() and [r.n for r in sums.collect()] == [3.0, 0.0]
