"""Mixing sources to target weights by pivotal dependent rounding.

Every source shall give its target number of words, so each of its documents is wanted
target / source_size times. The whole part of that number is taken outright; the fractional part is a
copy probability. Pivotal rounding settles these: two documents with fractional probabilities p and q
and sizes a and b meet, and words are moved between them at random, a*p + b*q unchanged and each
expectation unchanged, until one probability is 0 or 1. The other document goes on to the next meeting. The
words taken from a source therefore differ from its target by less than one document's size.

Meetings run as a reduction tree. Documents are dealt by a hash of their id into bins of about `BIN`, each bin
is folded and leaves one open document, bins are dealt into larger bins, and so on up to one document per
source, which a last draw settles. A source with a third of all rows is that many more bins. All draws
are hashes of ids and `seed`, so reruns agree. DataFrame functions only.

Sources, in code point order, nulls last, weigh 1, 2, 3, 1, 2, 3, ... and share all words by weight; a
target stops at `most` times its source's size, and the excess is shared by weight among the others
until none is above.

Odd cases: a null text has size 0 and is never taken; a source without words has target 0; null ids and
repeated rows are documents like any other (rows that agree in id, source and size are settled alike, as one document that counts as
often as it occurs). An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored
from .common import carried, text_of, unit_interval

#: documents of a bin, which are one array in one row
BIN = 64


def words(text: Column) -> Column:
    """How many runs of characters other than ASCII white space a text has."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def targets(sizes: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The capped sources are those that reach their cap first as the words per weight grow: in the order of cap
    divided by weight, a source is capped if what is left per weight, with all before it capped, reaches
    its cap. One ordered pass over a table of one row per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * most)
    rows = rows.withColumn("reach", F.col("cap") / F.col("weight"))
    before = W.orderBy("reach", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    share = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / share)
    rows = rows.withColumn("capped", F.col("reach") <= F.col("level"))
    # what the sources that are not capped get per weight
    open_level = F.min(F.when(~F.col("capped"), F.col("level"))).over(whole)
    first_open = F.min(F.when(~F.col("capped"), F.struct("reach", F.col("source").isNull().alias("n"), "source", "level"))).over(whole)
    rows = rows.withColumn("open_level", F.coalesce(first_open["level"], open_level))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("open_level"))
    return rows.select("source", "source_size", target.alias("target"))


def _meet(state: Column, item: Column, seed: int) -> Column:
    """One meeting: the open document of `state` and `item`; one of them is settled.

    Sizes are a and b, probabilities p and q. Moving words up to where p or q ends: towards the open document by
    x = min(a(1-p), bq), or towards the item by y = min(ap, b(1-q)); the first with chance y / (x + y).
    """
    a, p, b, q = state["open"]["size"], state["open"]["p"], item["size"], item["p"]
    up = F.least(a * (1 - p), b * q)
    down = F.least(a * p, b * (1 - q))
    draw = unit_interval(state["open"]["id"], item["id"], state["open"]["tie"], item["tie"], seed=seed)
    grows = draw * (up + down) < down
    moved = F.when(grows, up).otherwise(-down)
    # which of the two ends is decided on the bounds themselves, not on rounded results
    ends_open = F.when(grows, a * (1 - p) <= b * q).otherwise(a * p <= b * (1 - q))
    settled_open = F.struct(
        state["open"]["id"].alias("id"), state["open"]["tie"].alias("tie"), grows.cast("int").alias("extra")
    )
    settled_item = F.struct(item["id"].alias("id"), item["tie"].alias("tie"), (~grows).cast("int").alias("extra"))
    p_new = F.least(F.greatest(p + moved / a, F.lit(0.0)), F.lit(1.0))
    q_new = F.least(F.greatest(q - moved / b, F.lit(0.0)), F.lit(1.0))
    rest_open = F.struct(state["open"]["id"].alias("id"), state["open"]["tie"].alias("tie"), a.alias("size"), p_new.alias("p"))
    rest_item = F.struct(item["id"].alias("id"), item["tie"].alias("tie"), b.alias("size"), q_new.alias("p"))
    return F.struct(
        F.when(ends_open, rest_item).otherwise(rest_open).alias("open"),
        F.concat(state["done"], F.array(F.when(ends_open, settled_open).otherwise(settled_item))).alias("done"),
    )


def _fold(items: DataFrame, seed: int) -> DataFrame:
    """(source, bin, open, done) from (source, bin, id, tie, size, p): one row per bin."""
    item = F.struct("id", "tie", "size", "p")
    draw = F.xxhash64(F.lit(seed), "id", "tie")
    bins = items.groupBy("source", "bin").agg(F.sort_array(F.collect_list(F.struct(draw.alias("draw"), item.alias("item")))).alias("all"))
    bins = bins.withColumn("all", F.transform("all", lambda x: x["item"]))
    first = F.element_at("all", 1)
    none = F.array().cast("array<struct<id:bigint,tie:bigint,extra:int>>")
    start = F.struct(first.alias("open"), none.alias("done"))
    rest = F.slice("all", F.lit(2), F.size("all"))
    return bins.select("source", "bin", F.aggregate(rest, start, lambda s, x: _meet(s, x, seed)).alias("state")).select(
        "source", "bin", "state.open", "state.done"
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    most: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: int = 1,
) -> DataFrame:
    """(id, size, source, source_size, target, copies, taken) for every row."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), words(text_of(text_col)).alias("size")
    )
    rows = stored(rows, "sizes")
    # rows that agree in all three are one document of `times` times the size
    tie = F.xxhash64("source", "size")
    items = rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).cast("long").alias("source_size"), F.count(F.lit(1)).alias("n"))
    aims = targets(sizes.select("source", "source_size"), most, weights)
    aims = sizes.select(F.col("source").alias("s"), "n").join(aims, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    aims = stored(
        aims.select(
            F.col("source").alias("s"), "source_size", "target", F.ceil(F.col("n") / BIN).cast("long").alias("bins"),
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("wanted"),
        ),
        "targets",
    )
    bins = aims.agg(F.max("bins")).head()[0] or 0
    joined = items.join(aims, F.col("source").eqNullSafe(F.col("s"))).withColumn("tie", tie)
    open_now = joined.filter((F.col("size") > 0) & (F.col("wanted") > F.floor("wanted"))).select(
        "source",
        F.pmod(F.xxhash64(F.lit(seed), "id", "tie"), F.col("bins")).alias("bin"),
        "id",
        "tie",
        (F.col("size") * F.col("times")).cast("double").alias("size"),
        (F.col("wanted") - F.floor("wanted")).alias("p"),
    )
    settled = []
    level = 0
    while True:
        folded = stored(_fold(open_now, seed + level), "folded")
        settled.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.id", "d.tie", "d.extra"))
        open_now = folded.select("source", F.floor(F.col("bin") / BIN).alias("bin"), "open.*")
        level += 1
        if bins <= 1:
            break
        bins = -(-bins // BIN)
    settled.append(
        open_now.select("source", "id", "tie", (unit_interval("id", "tie", seed=seed - 1) < F.col("p")).cast("int").alias("extra"))
    )
    extra = reduce(DataFrame.unionByName, settled).select(F.col("source").alias("es"), F.col("id").alias("eid"), F.col("tie").alias("et"), "extra")
    decided = joined.join(
        extra,
        F.col("id").eqNullSafe(F.col("eid")) & (F.col("tie") == F.col("et")) & F.col("source").eqNullSafe(F.col("es")),
        "left",
    )
    copies = (F.floor("wanted") + F.coalesce("extra", F.lit(0))).cast("int")
    decided = stored(
        decided.select(
            F.col("id").alias("did"), F.col("source").alias("ds"), F.col("size").alias("dz"), "source_size", "target",
            F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"),
        ),
        "decided",
    )
    same = F.col("id").eqNullSafe(F.col("did")) & F.col("source").eqNullSafe(F.col("ds")) & (F.col("size") == F.col("dz"))
    return rows.join(decided, same).select(
        "id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    found = mix(docs, id_col, text_col, source_col, **how).select("id", "source", "size", "copies")
    found = stored(found.filter("copies > 0").distinct(), "copies")
    keys = {"own_id": F.col(id_col).cast("long"), "own_source": F.col(source_col).cast("string"), "own_size": words(text_of(text_col))}
    rows = carried(docs, **keys)
    same = F.col("own_id").eqNullSafe(F.col("id")) & F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_size") == F.col("size"))
    return rows.join(found.hint("merge"), same).select("carried", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("carried.*")
