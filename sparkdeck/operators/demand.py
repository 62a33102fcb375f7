"""Article tables for a demand model: one chain from raw columns to features, for learning and for prediction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import bin_by, prior_mean, quantile_cuts
from .relational import lookup

#: shares of the price bins
QUARTILES = [0.0, 0.25, 0.5, 0.75]
FEATURES = ["season", "age", "quarter", "price_bin", "ref_code", "ref_kind"]


def prepare_articles(
    articles: DataFrame, orders: DataFrame, lookups: list[tuple[DataFrame, str, str, str]], learn: list[int], pred: list[int], counted: str = "R"
) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from and rows to predict, with the same features.

    `articles` has (article, collection, colour, family, age, price, first_day), `first_day` as dd/MM/yyyy; `orders` has
    (article, collection, kind, qty). Only the collections of `learn` and `pred` are returned.

    * `sold` sums the orders of the kind `counted` per article and collection, 0 without any.
    * each of `lookups` (table, key, value, out) adds a name by its key, "other" where the table has none.
    * `quarter` is that of the first day; rows without a readable day, price or age are left out.
    * `price_bin` are quartiles of the learning rows' prices; the lowest and the highest bin are open.
    * `ref_code` and `ref_kind` are the mean of `sold` in earlier collections, of the article and of its colour, family and age;
      0 without any. Only learning rows are looked back on, also from prediction rows, whose sales are not known.
    """
    sums = orders.filter(F.col("kind") == counted).groupBy("article", "collection").agg(F.sum("qty").cast("double").alias("sold"))
    rows = articles.filter(F.col("collection").isin([*learn, *pred])).join(sums, ["article", "collection"], "left")
    rows = rows.withColumns({"sold": F.coalesce("sold", F.lit(0.0)), "quarter": F.quarter(F.try_to_date("first_day", "dd/MM/yyyy"))})
    for dim, key, value, out in lookups:
        rows = lookup(rows, dim, key, value, "other", out)
    rows = rows.dropna("any", subset=["age", "price", "quarter"])
    known = F.col("collection").isin(learn)
    cuts = quantile_cuts(rows.filter(known), "price", QUARTILES)
    rows = bin_by(rows, "price", [-float("inf"), *cuts[1:]] if cuts else [], "price_bin")
    rows = rows.withColumns({"season": F.col("collection").cast("double"), "_known": F.when(known, F.col("sold"))})
    rows = prior_mean(rows, ["article"], "collection", "_known", out="ref_code")
    rows = prior_mean(rows, ["colour", "family", "age"], "collection", "_known", out="ref_kind").drop("_known")
    return rows.filter(known), rows.filter(F.col("collection").isin(pred))
