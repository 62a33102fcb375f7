"""Ordered operators: running values, run lengths, gap filling, quantiles, top-k, latest.

A window sends one key to one task. `Walk` therefore range-partitions the rows on key and order, so that Spark's
own ordering cuts every large key into blocks, whatever the types of the columns and the number of large
keys. Each block of a key is windowed by itself, and one summary row per block carries the running state into
the next block. Only keys that lie in more than one partition need that; there are fewer of them than
partitions. There is one path for every size, and a block is as large as a shuffle partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..session import stored

BLOCK = "_block"
ALL = "_all"


def number_of(df: DataFrame, name: str) -> Column:
    """A time or number column as a double, for distances along it (not for ordering)."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        col = F.unix_micros(col.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        col = F.unix_date(col)
    return col.cast("double")


def matches(names: list[str], other: str = "_c_") -> Column:
    """Null-safe equality of columns with their prefixed counterparts."""
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{other}{n}")) for n in names])


class Walk:
    """Visit the rows of each key in order; `order` must be unique within a key.

    The blocked rows are written once, so what follows does not evaluate the input again.
    """

    def __init__(self, df: DataFrame, by: list[str], order: list[str], partitions: int | None = None):
        self.added: list[str] = [BLOCK]
        if not by:
            df, by = df.withColumn(ALL, F.lit(0)), [ALL]
            self.added.append(ALL)
        self.by, self.order = by, order
        # without a number, partitions follow the bytes that the shuffle has measured
        ranged = df.repartitionByRange(*([partitions] if partitions else []), *by, *order)
        self.df = stored(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")
        # of a sorted partition only the first key can go on from an earlier one: at most one row per partition
        key = F.struct(*by)
        ends = self.df.groupBy(BLOCK).agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
        parts = ends.select(F.inline(F.array(F.struct(BLOCK, F.col("_low").alias("_k")), F.struct(BLOCK, F.col("_high").alias("_k")))))
        cut = parts.groupBy("_k").agg(F.count_distinct(BLOCK).alias("_n")).filter("_n > 1")
        # found once, however many columns are added; its written size tells the planner that it is small
        self.cut = stored(cut.select(*[F.col(f"_k.{c}").alias(f"_k_{c}") for c in by]), "cut")

    def add(
        self,
        running: dict[str, Column] | None = None,
        prev: dict[str, Column] | None = None,
        last: dict[str, Column] | None = None,
        following: dict[str, Column] | None = None,
    ) -> Walk:
        """Add columns: inclusive running sum, previous row's value, latest non-null value up to the
        row, nearest non-null value from the row on."""
        running, prev, last, following = (d or {} for d in (running, prev, last, following))
        keys = [*self.by, BLOCK]
        forward = Window.partitionBy(*keys).orderBy(*self.order)
        upto = forward.rowsBetween(Window.unboundedPreceding, 0)
        # "from here to the end" is read as "up to here" in the opposite order, which streams
        onward = (
            Window.partitionBy(*keys)
            .orderBy(*[F.col(c).desc() for c in self.order])
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        cols = {n: F.sum(c).over(upto) for n, c in running.items()}
        cols |= {n: F.lag(c).over(forward) for n, c in prev.items()}
        cols |= {n: F.last(c, ignorenulls=True).over(upto) for n, c in last.items()}
        cols |= {n: F.last(c, ignorenulls=True).over(onward) for n, c in following.items()}

        rank = F.struct(*self.order)
        # at most as many cut keys as partitions, so this side may be broadcast
        spanning = self.df.join(F.broadcast(self.cut), matches(self.by, "_k_"), "left_semi")
        summary = spanning.groupBy(*keys).agg(
            *[F.sum(c).alias(n) for n, c in running.items()],
            *[F.max_by(F.struct(c.alias("v")), rank).alias(n) for n, c in prev.items()],
            *[F.max_by(F.struct(c.alias("v")), F.when(c.isNotNull(), rank)).alias(n) for n, c in last.items()],
            *[F.min_by(F.struct(c.alias("v")), F.when(c.isNotNull(), rank)).alias(n) for n, c in following.items()],
            F.lit(1).alias("_one"),
        )
        chain = Window.partitionBy(*self.by).orderBy(BLOCK)
        before = chain.rowsBetween(Window.unboundedPreceding, -1)
        after = (
            Window.partitionBy(*self.by)
            .orderBy(F.col(BLOCK).desc())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = summary.select(
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            *[F.sum(n).over(before).alias(f"_c_{n}") for n in running],
            *[F.lag(n).over(chain).alias(f"_c_{n}") for n in prev],
            *[F.last(n, ignorenulls=True).over(before).alias(f"_c_{n}") for n in last],
            *[F.last(n, ignorenulls=True).over(after).alias(f"_c_{n}") for n in following],
        )
        cols["_first"] = F.row_number().over(forward) == 1
        # one row per block of a cut key: at most two per partition
        joined = self.df.withColumns(cols).join(F.broadcast(carried), matches(keys), "left")
        fixed = {n: F.coalesce(F.col(n) + F.col(f"_c_{n}"), F.col(n), F.col(f"_c_{n}")) for n in running}
        fixed |= {n: F.when(F.col("_first"), F.col(f"_c_{n}.v")).otherwise(F.col(n)) for n in prev}
        fixed |= {n: F.coalesce(F.col(n), F.col(f"_c_{n}.v")) for n in [*last, *following]}
        self.df = joined.withColumns(fixed).drop(
            "_first", *[f"_c_{n}" for n in [*keys, *running, *prev, *last, *following]]
        )
        return self

    def result(self, *drop: str) -> DataFrame:
        return self.df.drop(*drop, *self.added)


def row_index(df, by, order, out="idx", partitions=None) -> DataFrame:
    """Dense 1-based row number per key (whole table for an empty key)."""
    return Walk(df, by, order, partitions).add(running={out: F.lit(1).cast("bigint")}).result()


def running_sum(df, by, order, value, out, partitions=None) -> DataFrame:
    return Walk(df, by, order, partitions).add(running={out: F.col(value)}).result()


def state_run_length(df, by, order, state_cols, out="run", when_null=None, partitions=None):
    """Rows since the state last changed: 0 on the first row and on a change, then 1, 2, 3…

    A null among the compared columns counts as a change. `when_null=(probe, cols)` compares `cols`
    instead of `state_cols` on rows where `probe` is null.
    """
    names = list(state_cols) + [c for c in (when_null[1] if when_null else []) if c not in state_cols]
    walk = Walk(df, by, order, partitions).add(
        prev={"_prev": F.struct(*names)}, running={"_idx": F.lit(1).cast("bigint")}
    )

    def equal(cols):
        tests = [F.col(c) == F.col(f"_prev.{c}") for c in cols]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))

    kept = equal(state_cols)
    if when_null:
        kept = F.when(F.col(when_null[0]).isNull(), equal(when_null[1])).otherwise(kept)
    walk.add(last={"_start": F.when(~kept, F.col("_idx"))})
    walk.df = walk.df.withColumn(out, F.col("_idx") - F.col("_start"))
    return walk.result("_prev", "_idx", "_start")


def nonzero_run(df, by, order, col, out="run", partitions=None) -> DataFrame:
    """Count of consecutive non-zero rows so far; 0 on a zero or a null."""
    zero = F.coalesce(F.col(col) == 0, F.lit(True))
    walk = Walk(df, by, order, partitions).add(running={"_idx": F.lit(1).cast("bigint")})
    walk.add(last={"_zero": F.when(zero, F.col("_idx"))})
    count = F.col("_idx") - F.coalesce(F.col("_zero"), F.lit(0))
    walk.df = walk.df.withColumn(out, F.when(zero, F.lit(0)).otherwise(count).cast("bigint"))
    return walk.result("_idx", "_zero")


def period_return(df, by, order, price, out="ret", partitions=None) -> DataFrame:
    """Relative change against the previous row; null on the first row and after a zero price."""
    walk = Walk(df, by, order, partitions).add(prev={"_p": F.col(price)})
    walk.df = walk.df.withColumn(
        out, F.when(F.col("_p") != 0, (F.col(price) - F.col("_p")) / F.col("_p"))
    )
    return walk.result("_p")


def interpolate(df, by, order, value, out=None, by_time=False, partitions=None) -> DataFrame:
    """Linear fill of null values along `order`: equally spaced rows, or true distance if `by_time`.

    A trailing gap repeats the last value; a leading gap stays null.
    """
    walk = Walk(df, by, [order], partitions)
    if by_time:
        walk.df = walk.df.withColumn("_x", number_of(walk.df, order))
    else:
        walk.add(running={"_x": F.lit(1).cast("bigint")})
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_x").alias("x"), F.col(value).alias("y")))
    walk.add(last={"_a": known}, following={"_b": known})
    x0, y0, x1, y1 = (F.col(c) for c in ("_a.x", "_a.y", "_b.x", "_b.y"))
    line = y0 + (y1 - y0) * (F.col("_x") - x0) / F.nullif(x1 - x0, F.lit(0))
    walk.df = walk.df.withColumn(out or value, F.coalesce(F.col(value), line, y0))
    return walk.result("_x", "_a", "_b")


def prior_mean(df, keys, order, value, default=0.0, out="prior", partitions=None) -> DataFrame:
    """Mean of `value` over rows of the same key with a strictly smaller `order`.

    Rows are summed per (key, order) before anything is ordered.
    """
    sums = df.groupBy(*keys, order).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    walk = Walk(sums, keys, [order], partitions).add(
        running={"_cs": F.coalesce(F.col("_s"), F.lit(0)), "_cn": F.col("_n")}
    )
    before = F.col("_cn") - F.col("_n")
    mean = (F.col("_cs") - F.coalesce(F.col("_s"), F.lit(0))) / F.nullif(before, F.lit(0))
    prior = walk.result().select(
        *[F.col(c).alias(f"_k_{c}") for c in [*keys, order]],
        F.coalesce(mean, F.lit(default)).alias(out),
    )
    test = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, order]])
    return df.join(prior, test, "left").drop(*[f"_k_{c}" for c in [*keys, order]])


def top_k(df, by, order: list[Column], k: int, rank="rank") -> DataFrame:
    """First k rows per key; the plan drops losing rows of a key before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def latest(df, key, order) -> DataFrame:
    """Row with the highest `order` per key, as an aggregate so that hot keys combine map-side."""
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def quantiles(df, by, value, probs: dict[str, float], partitions=None) -> DataFrame:
    """Exact interpolated quantiles per key, one column per entry of `probs`; nulls and NaN left out.

    Rows are counted per distinct value, the counts are summed along the values, and the two values around each
    wanted rank are picked by an aggregate, so no task holds a key.
    """
    clean = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    clean = clean.select(*by, F.col(value).cast("double").alias("_v"))
    names, shares = list(probs), [float(p) for p in probs.values()]
    keys = by
    if not by:
        clean, keys = clean.withColumn(ALL, F.lit(0)), [ALL]
    counts = clean.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    walk = Walk(counts, keys, ["_v"], partitions)
    totals = walk.df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_n").alias("_total"))
    ranked = walk.add(running={"_upto": F.col("_n")}).result().join(totals, matches(keys, "_k_"))
    spots = {i: (F.col("_total") - 1) * F.lit(p) for i, p in enumerate(shares)}
    picked = ranked.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_upto") > F.floor(s), F.col("_v"))).alias(f"_lo{i}") for i, s in spots.items()],
        *[F.min(F.when(F.col("_upto") > F.ceil(s), F.col("_v"))).alias(f"_hi{i}") for i, s in spots.items()],
        F.max("_total").alias("_total"),
    )
    exact = {
        names[i]: F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (s - F.floor(s)) for i, s in spots.items()
    }
    return picked.select(*by, *[c.alias(n) for n, c in exact.items()])


def quantile_cuts(df, value, probs: list[float], partitions=None) -> list[float]:
    """The quantiles of a column as a fixed, small number of scalars on the driver; none for a table without values."""
    row = quantiles(df, [], value, {f"q{i}": p for i, p in enumerate(probs)}, partitions).first()
    return [] if row is None else [row[f"q{i}"] for i in range(len(probs))]


def bin_by(df, value, cuts: list[float], out="bin") -> DataFrame:
    """Right-closed bins between cut points, numbered from 1; lowest edge included, last bin open above, null below the lowest cut."""
    if not cuts:
        return df.withColumn(out, F.lit(None).cast("int"))
    expr = F.lit(len(cuts))
    for i in range(len(cuts) - 1, 0, -1):
        expr = F.when(F.col(value) <= cuts[i], F.lit(i)).otherwise(expr)
    low = F.col(value) < cuts[0]
    return df.withColumn(out, F.when(F.col(value).isNull() | low, F.lit(None)).otherwise(expr).cast("int"))


def quantile_bins(df, value, probs: list[float], out="bin", partitions=None) -> DataFrame:
    """`bin_by` the given quantiles of the same column."""
    return bin_by(df, value, quantile_cuts(df, value, probs, partitions), out)


def fold(df, order, k, out="fold", partitions=None) -> DataFrame:
    """k contiguous folds of near-equal size along `order` (larger folds first), numbered from 1."""
    n = df.count()
    small, extra = divmod(n, k)
    i = F.col("_i") - 1
    head = extra * (small + 1)
    tail = F.lit(extra) + F.floor((i - head) / F.lit(max(small, 1)))
    number = F.when(i < head, F.floor(i / F.lit(small + 1))).otherwise(tail) + 1
    return row_index(df, [], order, "_i", partitions).withColumn(out, number.cast("int")).drop("_i")


def covered(df, intervals, by, ts, out="covered", partitions=None) -> DataFrame:
    """1 where `ts` lies in an interval [s, e) of the same key, or (s, e) if `open_start`, else 0.

    `intervals` has the columns `by`, `s`, `e`, `open_start`. Starts and ends become +1/-1 rows between the
    data rows, and a running sum tells whether any interval is open, so nothing is broadcast and no pair
    is built.
    """
    names = df.columns
    iv = intervals.filter(F.col("s").cast("timestamp") < F.col("e").cast("timestamp"))
    keyed = df.withColumns(
        {
            "_t": F.col(ts).cast("timestamp"),
            "_kind": F.lit(1),
            "_step": F.lit(0),
            "_id": F.monotonically_increasing_id(),
        }
    )
    # at one instant: ends and closed starts first, then rows, then starts that exclude their instant
    edges = [
        iv.select(
            *by,
            F.col("s").cast("timestamp").alias("_t"),
            F.when(F.col("open_start"), 2).otherwise(0).alias("_kind"),
            F.lit(1).alias("_step"),
        ),
        iv.select(
            *by, F.col("e").cast("timestamp").alias("_t"), F.lit(0).alias("_kind"), F.lit(-1).alias("_step")
        ),
    ]
    marks = reduce(lambda a, b: a.unionByName(b), edges)
    marks = marks.groupBy(*by, "_t", "_kind").agg(F.sum("_step").cast("int").alias("_step"))
    marks = marks.withColumn("_id", F.lit(-1).cast("bigint"))
    rows = keyed.unionByName(marks, allowMissingColumns=True)
    swept = Walk(rows, by, ["_t", "_kind", "_id"], partitions).add(running={"_open": F.col("_step")}).result()
    return swept.filter(F.col("_id") >= 0).select(*names, (F.col("_open") > 0).cast("int").alias(out))
