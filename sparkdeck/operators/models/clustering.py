"""Centre-based and density clustering."""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ...session import fresh_path, stored


def kmeans(df: DataFrame, k: int, features="features", iters: int = 20, seed: int = 1):
    return KMeans(k=k, featuresCol=features, maxIter=iters, seed=seed).fit(df)


def _squared(vector: Column, center) -> Column:
    """Squared distance of an array column to one fixed centre."""
    terms = F.zip_with(vector, F.array(*[F.lit(float(c)) for c in center]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


def with_distance(df: DataFrame, model, features="features") -> DataFrame:
    """Rows with `prediction` and the squared distance to its centre and to the nearest centre."""
    rows = model.transform(df).withColumn("_v", vector_to_array(features))
    each = F.array(*[_squared(F.col("_v"), c) for c in model.clusterCenters()])
    rows = rows.withColumn("_d", each)
    return rows.withColumns({"d2": F.col("_d")[F.col("prediction")], "best_d2": F.array_min("_d")}).drop("_v", "_d")


def wssse(df: DataFrame, model, features="features") -> DataFrame:
    """Within-set sum of squared errors of any table under a model."""
    return with_distance(df, model, features).agg(F.sum("d2").alias("wssse"), F.count(F.lit(1)).alias("n"))


def sweep(df: DataFrame, ks: list[int], features="features", iters: int = 20, seed: int = 1):
    """One model per k and the elbow table (k, wssse), k in numeric order."""
    df = stored(df.select(features), "points")  # every k reads them again
    models = {k: kmeans(df, k, features, iters, seed) for k in sorted(ks)}
    rows = [(k, float(m.summary.trainingCost)) for k, m in models.items()]
    return models, df.sparkSession.createDataFrame(rows, "k int, wssse double")


# --- density clustering -------------------------------------------------------------------------------
#
# Cells have the side eps / sqrt(d), so any two points of a cell are neighbours. A cell with at least
# `min_points` points is all core; only points of thinner cells are compared with others, and those
# cells hold fewer than `min_points` points each, so comparisons stay linear in the table. Core points
# of a cell are always connected, so components are taken over cells. Whether two cells touch is
# decided on bounding boxes that are halved until every pair of boxes is surely near or surely far.


def _cell_names(cols):
    return [f"_c{i}" for i in range(len(cols))]


def _around(df: DataFrame, cells: list[str]) -> DataFrame:
    """One row per neighbouring cell that can hold a point within eps (own cell included)."""
    reach = math.ceil(math.sqrt(len(cells)))
    steps = [
        s
        for s in product(range(-reach, reach + 1), repeat=len(cells))
        if sum(max(abs(v) - 1, 0) ** 2 for v in s) <= len(cells)
    ]
    shifts = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(s, cells)]) for s in steps])
    out = df.withColumn("_s", F.explode(shifts))
    return out.withColumns({f"_n{c}": F.col(c) + F.col(f"_s.{c}") for c in cells}).drop("_s")


def _near_points(df: DataFrame, others: DataFrame, cols: list[str], cells: list[str], eps: float) -> DataFrame:
    """Pairs (row, other) within eps; `others` columns carry the prefix `o_`."""
    right = others.select(*[F.col(c).alias(f"o_{c}") for c in others.columns])
    same_cell = reduce(lambda a, b: a & b, [F.col(f"_n{c}") == F.col(f"o_{c}") for c in cells])
    dist = reduce(lambda a, b: a + b, [F.pow(F.col(c) - F.col(f"o_{c}"), 2) for c in cols])
    return _around(df, cells).join(right, same_cell).filter(dist <= eps * eps)


def _touching(core: DataFrame, cols: list[str], cells: list[str], eps: float) -> DataFrame:
    """Unordered pairs of core cells with two core points within eps, by halving boxes."""
    n = len(cols)
    side = eps / math.sqrt(n)
    key = F.struct(*cells)
    points = core.select(key.alias("cell"), *cols).distinct()
    found, open_pairs, level = [], None, 0
    while True:
        parts = 2**level
        sub = [F.floor(F.col(c) / (side / parts)).alias(f"s{i}") for i, c in enumerate(cols)]
        boxes = points.withColumn("sub", F.struct(*sub)).groupBy("cell", "sub").agg(
            *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
            *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)],
        )
        if open_pairs is None:
            around = _around(boxes.select("cell", "cell.*").distinct(), cells)
            other = F.struct(*[F.col(f"_n{c}").cast("bigint").alias(c) for c in cells])
            open_pairs = around.select(F.col("cell").alias("a"), other.alias("b")).filter("a < b")
            open_pairs = open_pairs.join(boxes.select(F.col("cell").alias("b")).distinct(), "b", "left_semi")
            left = open_pairs.select("a", "b")
            pairs = left.join(boxes.select(F.col("cell").alias("a"), *_named(boxes, "a_")), "a").join(
                boxes.select(F.col("cell").alias("b"), *_named(boxes, "b_")), "b"
            )
        else:
            # boxes one level down meet only inside box pairs that are still open
            up = F.struct(*[F.floor(F.col(f"sub.s{i}") / 2).alias(f"s{i}") for i in range(n)])
            boxes = boxes.withColumn("up", up)
            pairs = open_pairs.join(
                boxes.select(F.col("cell").alias("a"), F.col("up").alias("a_sub"), *_named(boxes, "na_")), ["a", "a_sub"]
            ).join(
                boxes.select(F.col("cell").alias("b"), F.col("up").alias("b_sub"), *_named(boxes, "nb_")), ["b", "b_sub"]
            )
            pairs = pairs.select("a", "b", *[F.col(f"n{s}_{m}").alias(f"{s}_{m}") for s in "ab" for m in _members(n)])
        gap = reduce(
            lambda x, y: x + y,
            [
                F.pow(F.greatest(F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.lit(0.0)), 2)
                for i in range(n)
            ],
        )
        span = reduce(
            lambda x, y: x + y,
            [
                F.pow(F.greatest(F.col(f"a_hi{i}") - F.col(f"b_lo{i}"), F.col(f"b_hi{i}") - F.col(f"a_lo{i}")), 2)
                for i in range(n)
            ],
        )
        judged = stored(
            pairs.withColumns({"_gap": gap, "_span": span}).filter(F.col("_gap") <= eps * eps), "boxes"
        )
        sure = judged.filter(F.col("_span") <= eps * eps).select("a", "b").distinct()
        found.append(sure)
        open_pairs = judged.filter(F.col("_span") > eps * eps).join(sure, ["a", "b"], "left_anti")
        open_pairs = open_pairs.select("a", "b", "a_sub", "b_sub")
        if open_pairs.isEmpty():
            return reduce(lambda x, y: x.unionByName(y), found).distinct()
        level += 1


def _members(n):
    return ["sub", *[f"lo{i}" for i in range(n)], *[f"hi{i}" for i in range(n)]]


def _named(boxes, prefix):
    n = sum(c.startswith("lo") for c in boxes.columns)
    return [F.col(m).alias(prefix + m) for m in _members(n)]


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): smallest node of each connected part.

    Alternating star steps (published for map-reduce): first every node hands its larger neighbours to
    the smallest node it knows, then its smaller ones. Edges turn into stars around the smallest node in
    a number of rounds that grows with the logarithm of the graph; rounds go on until nothing moves. Each step is an aggregate and a join
    with one row per node, and each round is written out, so a lost executor replays one round only.
    """
    links = edges.filter(F.col("a") != F.col("b"))
    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # larger neighbours are hung on the smallest node around
        large = both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        # smaller neighbours follow, and the node itself
        moved = large.join(lowest, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stored(moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        if new.count() == links.count() and new.join(links, ["u", "v"], "left_anti").isEmpty():
            roots = new.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        links = new


def _clustered_cores(located: DataFrame, cols: list[str], eps: float, min_points: int) -> tuple[DataFrame, DataFrame]:
    """Core points with the smallest cell of their cluster (`root`), and the points of thin cells."""
    cells = _cell_names(cols)
    weights = located.groupBy(*cells).agg(F.sum("_w").alias("_cell"))
    sized = located.join(weights, cells)
    dense = sized.filter(F.col("_cell") >= min_points)
    thin = sized.filter(F.col("_cell") < min_points)
    counted = (
        _near_points(thin.select(*cols, *cells), located, cols, cells, eps)
        .groupBy(*cols, *cells)
        .agg(F.sum("o__w").alias("_near"))
    )
    core_thin = counted.filter(F.col("_near") >= min_points).select(*cols, *cells)
    core = stored(dense.select(*cols, *cells).unionByName(core_thin), "core")
    node = F.struct(*cells)
    nodes = core.select(node.alias("node")).distinct()
    roots = components(nodes, _touching(core, cols, cells, eps))
    return stored(core.withColumn("node", node).join(roots, "node").drop("node"), "clusters"), thin


def _located(df: DataFrame, cols: list[str], eps: float) -> DataFrame:
    """Distinct places with their number of rows and their cell."""
    side = eps / math.sqrt(len(cols))
    places = df.groupBy(*[F.col(c).cast("double").alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("_w"))
    return places.withColumns({k: F.floor(F.col(c) / side) for k, c in zip(_cell_names(cols), cols)})


def density_clusters(df: DataFrame, id_col: str, cols: list[str], eps: float, min_points: int) -> DataFrame:
    """(id, core, cluster): cluster is the number of its smallest cell, -1 for noise.

    A border point between clusters takes the smallest cluster number. Points at the same coordinates
    are handled as one point with a weight.
    """
    cells = _cell_names(cols)
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    located = stored(_located(rows, cols, eps), "points")
    named, thin = _clustered_cores(located, cols, eps, min_points)
    border = thin.join(named, [*cols, *cells], "left_anti").select(*cols, *cells)
    reached = (
        _near_points(border, named, cols, cells, eps).groupBy(*cols).agg(F.min("o_root").alias("root"))
    )
    labels = named.select(*cols, "root", F.lit(True).alias("core")).unionByName(
        reached.select(*cols, "root", F.lit(False).alias("core"))
    )
    numbered = labels.withColumn("cluster", F.to_json("root")).drop("root")
    return rows.join(numbered, cols, "left").select(
        "id", F.coalesce("core", F.lit(False)).alias("core"), F.coalesce("cluster", F.lit("-1")).alias("cluster")
    )


def write_density_model(df: DataFrame, cols: list[str], eps: float, min_points: int, path: str) -> None:
    """Write the core points of a table by cell, each with its cluster, so that other tables can be matched with them."""
    named, _ = _clustered_cores(stored(_located(df, cols, eps), "points"), cols, eps, min_points)
    cores = named.select(*cols, *_cell_names(cols), F.to_json("root").alias("cluster"))
    cores.repartitionByRange(*_cell_names(cols)).sortWithinPartitions(*_cell_names(cols)).write.parquet(path)


def predict_density(df: DataFrame, id_col: str, cols: list[str], eps: float, path: str) -> DataFrame:
    """(id, cluster, distance) of rows that need not have been in the table of the model.

    A row belongs to the cluster of the nearest core point within `eps` (the one whose cluster comes first where several are
    as near), else it is noise: -1 and no distance. Only the cells around a row's own are compared with it; rows at one
    place are looked up once. Rows without coordinates are noise.
    """
    cells = _cell_names(cols)
    cores = df.sparkSession.read.parquet(path)
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    places = _located(rows.dropna(subset=cols), cols, eps).select(*cols, *cells)
    near = _near_points(places, cores, cols, cells, eps)
    distance = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(c) - F.col(f"o_{c}"), 2) for c in cols]))
    best = near.groupBy(*cols).agg(F.min(F.struct(distance.alias("distance"), F.col("o_cluster").alias("cluster"))).alias("_b"))
    found = rows.join(best, cols, "left")
    return found.select("id", F.coalesce("_b.cluster", F.lit("-1")).alias("cluster"), "_b.distance")


# --- mini-batch k-means -------------------------------------------------------------------------------

def minibatch_kmeans(
    df: DataFrame, id_col: str, cols: list[str], k: int, batches: int = 10, epochs: int = 2, seed: int = 1, start_rows: int = 2000
) -> list[list[float]]:
    """k centres by mini-batches: each batch moves a centre towards the mean of its rows by their share of all rows it has had.

    Rows are dealt over batches by a hash of their id and written by batch, so a step reads its own folder. A step is one
    aggregate with k rows; only centres and their counts are on the driver. The first centres are spread over a sample of about
    `start_rows` rows (by hash): the first at random, each other one far from those before it. Rows with a missing value are left out.
    """
    values = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.dropna(subset=cols).select(values.alias("v"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"))
    path = fresh_path(df.sparkSession, "batches")
    rows.withColumn("batch", F.pmod("h", F.lit(batches)).cast("int")).repartition(batches, "batch").write.partitionBy("batch").parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    n = dealt.count()
    sample = dealt.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < min(1.0, start_rows / max(n, 1)) * (1 << 30))
    points = np.array([r["v"] for r in sample.orderBy("h").limit(2 * start_rows).collect()]).reshape(-1, len(cols))
    if not len(points):
        raise ValueError("no rows")
    rng = np.random.default_rng(seed)
    centres = points[rng.integers(len(points), size=1)]
    while len(centres) < k:  # drawn in proportion to the squared distance; the best of a few draws stays
        far = ((points[:, None, :] - centres[None]) ** 2).sum(2).min(1)
        chance = far / far.sum() if far.sum() > 0 else None
        draws = points[rng.choice(len(points), size=8, p=chance)]
        left = [np.minimum(far, ((points - d) ** 2).sum(1)).sum() for d in draws]
        centres = np.vstack([centres, draws[int(np.argmin(left))]])
    had = np.zeros(k)
    for step in range(epochs * batches):
        each = F.array(*[_squared(F.col("v"), c) for c in centres])
        place = F.array_position(each, F.array_min(each)) - 1
        sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(cols))]
        for r in dealt.filter(F.col("batch") == step % batches).groupBy(place.alias("c")).agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            had[r["c"]] += r["n"]
            centres[r["c"]] += (np.array([r[f"s{i}"] for i in range(len(cols))]) - r["n"] * centres[r["c"]]) / had[r["c"]]
    return centres.tolist()


def assigned(df: DataFrame, cols: list[str], centres: list[list[float]]) -> DataFrame:
    """Rows with `prediction`, the number of the nearest centre, and `d2`, the squared distance to it; null where a value is missing."""
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    each = F.array(*[_squared(vector, c) for c in centres])
    nearest = F.array_min(each)
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.withColumns({"prediction": F.when(there, F.array_position(each, nearest) - 1), "d2": F.when(there, nearest)})
