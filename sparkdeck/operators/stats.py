"""Column statistics, scaling and evaluation figures."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from .ordered import Walk, quantiles


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column, one row per column."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = numbers.unpivot([], cols, "name", "value")
    base = long.groupBy("name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return base.join(quantiles(long, ["name"], "value", probs), "name", "left")


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample variance and number of non-zero values per column, long form, one pass."""
    aggs = []
    for c in cols:
        nonzero = F.sum(F.when(F.col(c) != 0, 1).otherwise(0))
        aggs.append(F.struct(F.lit(c).alias("name"), F.avg(c).alias("mean"), F.var_samp(c).alias("variance"),
                             nonzero.alias("nonzero")))
    return df.agg(F.array(*aggs).alias("_s")).select(F.inline("_s"))


def _pairs(df: DataFrame, cols: list[str], fn) -> DataFrame:
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), fn(F.col(a), F.col(b)).alias("value"))
        for a, b in combinations_with_replacement(cols, 2)
    ]
    return df.agg(F.array(*cells).alias("_s")).select(F.inline("_s"))


def average_ranks(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rank of each value, ties share their mean rank; ranks come from counts per distinct value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    walk = Walk(counts, [], [col]).add(running={"_upto": F.col("_n")}).result()
    ranks = walk.select(col, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))
    return df.join(ranks, col, "left")


def corr_matrix(df: DataFrame, cols: list[str], method: str = "pearson") -> DataFrame:
    """Correlation of every pair of columns in one aggregate; Spearman correlates average ranks."""
    if method == "spearman":
        df = df.select(*cols)
        for c in cols:
            df = average_ranks(df, c, f"_r_{c}")
        df = df.select(*[F.col(f"_r_{c}").alias(c) for c in cols])
    return _pairs(df, cols, F.corr)


def cov_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    return _pairs(df, cols, F.covar_samp)


def cov_long(df: DataFrame, series: str, at: str, value: str) -> DataFrame:
    """(a, b, value), a <= b: sample covariance of every two series in long form over the places both have.

    The places are grouped, so a place holds one row per series.
    """
    left = df.select(F.col(at).alias("_at"), F.col(series).alias("a"), F.col(value).alias("_x"))
    right = df.select(F.col(at).alias("_at"), F.col(series).alias("b"), F.col(value).alias("_y"))
    pairs = left.join(right, "_at").filter(F.col("a") <= F.col("b"))
    return pairs.groupBy("a", "b").agg(F.covar_samp("_x", "_y").alias("value"))


def rmse(df: DataFrame, label: str, pred: str) -> DataFrame:
    err = F.col(label) - F.col(pred)
    return df.agg(F.avg(err * err).alias("mse"), F.sqrt(F.avg(err * err)).alias("rmse"), F.count(err).alias("n"))


def r2(df: DataFrame, label: str, pred: str) -> DataFrame:
    err = F.col(label) - F.col(pred)
    rows = df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull())
    return rows.agg((1 - F.sum(err * err) / (F.var_pop(label) * F.count(label))).alias("r2"))


def error_rate(df: DataFrame, label: str, pred: str) -> DataFrame:
    wrong = (F.col(label) != F.col(pred)).cast("double")
    return df.agg(F.avg(wrong).alias("error"), F.count(wrong).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class. Labels and predictions are counted once each, as
    a small confusion table."""
    cells = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("label") == F.col("pred")
    long = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("chosen"),
                         F.when(hit, F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("pred").alias("class"), F.lit(0).alias("support"), F.col("n").alias("chosen"),
                         F.lit(0).alias("tp")),
            )
        )
    )
    per = long.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "chosen", "tp")])
    p = F.coalesce(F.try_divide("tp", "chosen"), F.lit(0.0))
    r = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return (
        per.withColumns({"precision": p, "recall": r})
        .withColumn("f1", f1)
        .select("class", "precision", "recall", "f1", "support")
    )


def weighted_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row."""
    per = classification_report(df, label, pred)
    w = F.sum("support")
    return per.agg(
        (F.sum(F.col("recall") * F.col("support")) / w).alias("accuracy"),
        *[(F.sum(F.col(c) * F.col("support")) / w).alias(c) for c in ("precision", "recall", "f1")],
    )


def roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold table: rows with a score at or above each distinct score, true and false positive
    counts and rates. Rows are counted per score before anything is ordered."""
    per = (
        df.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_p"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_n"),
        )
        .withColumn("_neg", -F.col("threshold"))
    )
    curve = Walk(per, [], ["_neg"]).add(running={"tp": F.col("_p"), "fp": F.col("_n")}).result("_neg")
    totals = per.agg(F.sum("_p"), F.sum("_n")).first()
    pos, neg = float(totals[0] or 0), float(totals[1] or 0)
    return curve.withColumns(
        {
            "tpr": F.col("tp") / F.lit(pos) if pos else F.lit(None).cast("double"),
            "fpr": F.col("fp") / F.lit(neg) if neg else F.lit(None).cast("double"),
        }
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the curve: share of (positive, negative) pairs in the right order, ties half."""
    curve = roc(df, label, score)
    # negatives strictly below a score = all negatives - fp; ties count half
    total_p, total_n = F.sum("_p"), F.sum("_n")
    above = F.sum(F.col("_p") * F.col("fp")) - F.sum(F.col("_p") * F.col("_n")) / 2
    return curve.agg((1 - above / F.nullif(total_p * total_n, F.lit(0))).alias("auc"))


def best_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold with the largest true minus false positive rate (highest threshold on a tie)."""
    gain = F.round(F.col("tpr") - F.col("fpr"), 12)
    return roc(df, label, score).orderBy(gain.desc(), F.col("threshold").desc()).limit(1).select(
        "threshold", "tpr", "fpr"
    )


def baselines(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of the majority class, of a shuffled copy of the labels (expected) and of a uniform guess."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return n.agg(
        (F.max("n") / total).alias("majority"),
        (F.sum(F.col("n").cast("double") * F.col("n")) / (total * total)).alias("shuffled"),
        (1 / F.count("n")).alias("uniform"),
    )


def scale(df: DataFrame, cols: list[str], how: str = "standard", fit_on: DataFrame | None = None, population=False):
    """Standard, min-max or mean scaling with figures taken from `fit_on` (a few scalars per column)."""
    source = fit_on if fit_on is not None else df
    std = F.stddev_pop if population else F.stddev_samp
    row = source.agg(
        *[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("avg", F.avg), ("std", std), ("min", F.min), ("max", F.max))]
    ).first()
    new = {}
    for c in cols:
        avg, sd, lo, hi = (row[f"{c}_{n}"] for n in ("avg", "std", "min", "max"))
        base, width = {"standard": (avg, sd), "minmax": (lo, hi - lo), "mean": (avg, hi - lo)}[how]
        centred = F.col(c) - F.lit(float(base))
        new[c] = centred / F.lit(float(width)) if width else centred
    return df.withColumns(new)


def align_clusters(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Most frequent label per cluster (smallest label on a tie)."""
    n = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct(label, "n"), F.struct(F.col("n"), -F.col(label))).alias("_b")
    return n.groupBy(cluster).agg(best).select(cluster, f"_b.{label}", F.col("_b.n").alias("n"))
