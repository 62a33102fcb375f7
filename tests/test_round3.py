"""Reconstruction, density prediction, mini-batches, residuals, nearest points by cells, growing index, and checks that refuse wrong models."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from sparkdeck.operators import features, reconstruct, search, spatial
from sparkdeck.operators.models import clustering, regression
from sparkdeck.plans import learn
from sparkdeck.plans.views import Tables
from sparkdeck.session import fresh_path, stored


def plain_fill(rows, k, group=lambda p: 0):
    held = {}
    for p, d, v in rows:
        if v is not None:
            held.setdefault(p, {})[d] = v
        else:
            held.setdefault(p, {})
    out = {}
    for p, own in held.items():
        for d in {d for _, d, _ in rows}:
            if d in own:
                out[p, d] = (own[d], False)
                continue
            near = []
            for o, other in held.items():
                common = own.keys() & other.keys()
                if o != p and d in other and common and group(o) == group(p):
                    near.append((sum((own[c] - other[c]) ** 2 for c in common) / len(common), o, other[d]))
            near = sorted(near)[:k]
            exact = [v for dist, _, v in near if dist == 0]
            if not near:
                out[p, d] = (None, False)
            elif exact:
                out[p, d] = (sum(exact) / len(exact), True)
            else:
                out[p, d] = (sum(v / x for x, _, v in near) / sum(1 / x for x, _, _ in near), True)
    return out


@pytest.mark.parametrize("block", [3, 7, 256])
@pytest.mark.parametrize("grouped", [False, True])
def test_knn_fill_equals_brute_force(spark, block, grouped):
    rng = random.Random(5)
    rows = [(p, d, float(rng.randint(0, 4))) for p in range(20) for d in range(8) if rng.random() < 0.7]
    rows += [(30, 2, None), (31, 0, 1.0), (32, 99, 5.0), (40, 1, 2.0), (41, 1, 2.0), (41, 3, 7.0), (42, 1, 2.0), (42, 3, 9.0)]
    df = spark.createDataFrame([(p, d, v, p % 2) for p, d, v in rows], "p long, d long, v double, crop long")
    out = reconstruct.knn_fill(df.select("p", "d", "v", "crop") if grouped else df.select("p", "d", "v"), "p", "d", "v", 3, "crop" if grouped else None, block)
    got = {(r.p, r.d): (r.v, r.filled) for r in out.collect()}
    want = plain_fill(rows, 3, (lambda p: p % 2) if grouped else (lambda p: 0))
    assert got.keys() == want.keys()
    for key, (v, filled) in want.items():
        assert got[key][1] == filled and (got[key][0] is None) == (v is None), key
        assert v is None or abs(got[key][0] - v) < 1e-9, key
    assert sum(f for _, f in want.values()) > 20


def test_offers_look_at_few_series_and_equal_all(monkeypatch):
    """Of the exact distances only those of near series are computed; ties, dates that few series have and series at distance 0 included."""
    rng = np.random.default_rng(3)

    def block(first, n):
        rows = []
        for i in range(n):
            keys = np.flatnonzero(rng.random(12) < (0.05 if i % 9 == 0 else 0.8))
            rows.append((first + i, keys, rng.integers(0, 3, len(keys)).astype(float) + (1e3 if i % 4 == 0 else 0)))
        return pd.DataFrame(rows, columns=["number", "keys", "values"])

    left, right = block(0, 40), block(100, 90)
    asked = []
    real = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: asked.append(len(keys[0])) or real(keys))
    monkeypatch.setattr(reconstruct, "NEAR", 20)
    few = pd.concat(reconstruct._offers(left, right, 3), ignore_index=True)
    seen = sum(asked)
    asked.clear()
    monkeypatch.setattr(reconstruct, "NEAR", 1000)
    pd.testing.assert_frame_equal(few, pd.concat(reconstruct._offers(left, right, 3), ignore_index=True))
    assert len(few) > 100 and 0 < seen < 0.8 * sum(asked)


def test_knn_fill_offers_follow_blocks_and_widen(spark, monkeypatch):
    """Few hold the date that the others lack: the nearest do not have it and the search widens, over several steps of rows."""
    monkeypatch.setattr(reconstruct, "ROWS", 7)
    monkeypatch.setattr(reconstruct, "NEAR", 3)
    monkeypatch.setattr(reconstruct, "WIDER", 4)
    rows = [(p, d, float((p * 7 + d * d) % 23) + p / 100) for p in range(40) for d in range(6) if d != 3 or p % 8 == 0]
    x = {p: {d: v for q, d, v in rows if q == p} for p in range(40)}
    left, right = (pd.DataFrame({"number": [p for p in range(40) if p % 2 == s], "keys": [np.array(list(x[p])) for p in range(40) if p % 2 == s], "values": [np.array(list(x[p].values())) for p in range(40) if p % 2 == s]}) for s in (1, 0))
    found = reconstruct._offers(left, right, 2)
    assert len(found) == 1
    want = set()
    for p in left["number"]:
        near = sorted((sum((x[p][d] - x[o][d]) ** 2 for d in x[p] if d in x[o]) / len(x[p]), o) for o in right["number"] if 3 in x[o])
        want |= {(p, 3, o, round(s, 9), x[o][3]) for s, o in near[:2]}
    assert {(r.number, r.key, r.other, round(r.distance, 9), r.v) for r in found[0].itertuples()} == want


def test_knn_fill_of_nothing(spark):
    empty = spark.createDataFrame([], "p long, d date, v double")
    assert reconstruct.knn_fill(empty, "p", "d", "v").count() == 0
    alone = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "p string, d string, v double")
    assert {(r.p, r.d): r.v for r in reconstruct.knn_fill(alone, "p", "d", "v").collect()} == {("a", "x"): 1.0, ("b", "y"): 2.0, ("a", "y"): None, ("b", "x"): None}


def test_knn_fill_has_no_cross_join(spark, sf_dir):
    plan = reconstruct.knn_fill(stored(Tables(spark, sf_dir).v_series), "parcel", "d", "v")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_density_prediction_equals_brute_force(spark):
    rng = random.Random(8)
    spots = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(6)]
    known = [(k, *(c + rng.gauss(0, 0.25) for c in spots[k % 6])) for k in range(240)] + [(900 + k, rng.uniform(0, 10), rng.uniform(0, 10)) for k in range(40)]
    asked = [(k, rng.uniform(-1, 11), rng.uniform(-1, 11)) for k in range(200)] + [(500 + k, *known[k][1:]) for k in range(60)] + [(700, None, 1.0)]
    eps, least = 0.4, 6
    old, new = (spark.createDataFrame(r, "id long, x double, y double") for r in (known, asked))
    path = fresh_path(spark, "density")
    clustering.write_density_model(old, ["x", "y"], eps, least, path)
    label = {r.id: (r.core, r.cluster) for r in clustering.density_clusters(old, "id", ["x", "y"], eps, least).collect()}
    got = {r.id: (r.cluster, r.distance) for r in clustering.predict_density(new, "id", ["x", "y"], eps, path).collect()}
    assert len(got) == len(asked)
    hits = 0
    for k, x, y in asked:
        near = [(math.dist((x, y), p[1:]), label[p[0]][1]) for p in known if label[p[0]][0]] if x is not None else []
        near = min((n for n in near if n[0] <= eps), default=None)
        assert got[k][0] == (near[1] if near else "-1")
        assert near is None or abs(got[k][1] - near[0]) < 1e-9
        hits += near is not None
    assert 60 <= hits < len(asked) and len({label[k][1] for k in label}) > 3


def test_minibatches_come_near_the_full_method(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0], [8, 0], [0, 8], [8, 8], [4, 16]])
    rows = [(k, *map(float, centres[k % 5] + rng.normal(0, 0.6, 2))) for k in range(3000)] + [(9999, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    found = clustering.minibatch_kmeans(df, "id", ["x", "y"], 5)
    assert np.allclose(found, clustering.minibatch_kmeans(df.repartition(7), "id", ["x", "y"], 5))
    mine = clustering.assigned(df, ["x", "y"], found)
    assert mine.filter("prediction is null").count() == 1
    cost = mine.agg(F.sum("d2")).first()[0]
    full = KMeans(k=5, seed=1).fit(features.assemble(df.dropna(), ["x", "y"])).summary.trainingCost
    assert cost <= 1.05 * full
    untrained = df.dropna().orderBy("id").limit(1).select("x", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"), "y").select("x", (F.col("y") + F.col("k") / 10).alias("y"))
    wrong = clustering.assigned(df, ["x", "y"], [list(r) for r in untrained.collect()])
    assert wrong.agg(F.sum("d2")).first()[0] > 1.05 * full


def test_residual_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 4).alias("k"), F.col("id").cast("double").alias("y"), (F.col("id") % 100).cast("double").alias("prediction"))
    out = regression.residuals(rows, "y")
    assert out.filter("abs(residual - (y - prediction)) > 0").count() == 0
    values = sorted(r.residual for r in out.collect())
    sketches = regression.residual_sketch(out, ["k"])
    assert sketches.agg(F.sum("n")).first()[0] == 20_000 and sketches.count() == 4
    for r in regression.residual_quantiles(sketches, [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        assert abs(np.searchsorted(values, r.residual) - r.share * 20_000) <= 0.02 * 20_000 + 100


@pytest.mark.parametrize("point", [(5.0, 5.0), (0.01, 9.99), (-40.0, 3.0), (300.0, 300.0)])
def test_nearest_by_cells_equal_all_rows(spark, point):
    rng = random.Random(1)
    rows = [(k, round(rng.uniform(0, 10), 1), round(rng.uniform(0, 10), 1)) for k in range(3000)] + [(5000 + k, 5.0, 5.0) for k in range(20)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    path = fresh_path(spark, "cells")
    spatial.write_cells(df, "x", "y", 0.25, path)
    located = spark.read.parquet(path)
    for k in (1, 15, 4000):
        want = [r.id for r in spatial.knn_points(df, "x", "y", *point, k, "id").collect()]
        assert [r.id for r in spatial.knn_by_cell(located, "x", "y", *point, k, "id", 0.25).collect()] == want


def test_nearest_by_cells_reads_few_cells(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 200 / 20).alias("x"), (F.floor(F.col("id") / 200) / 20).alias("y"))
    path = fresh_path(spark, "cells")
    spatial.write_cells(df, "x", "y", 0.1, path)
    found = spatial.knn_by_cell(spark.read.parquet(path), "x", "y", 5.02, 5.03, 10, "id", 0.1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell_x" in plan and "PushedFilters: [IsNotNull(cell_y)" in plan
    read = spark.read.parquet(path).filter("cell_x between 48 and 52").select("cell_x").distinct().count()
    assert found.count() == 10 and read <= 5


def test_index_folders_follow_the_bytes(spark):
    df = spark.range(3000).select("id", F.concat_ws(" ", *[F.concat(F.lit("w"), (F.xxhash64("id", F.lit(k)) % 997).cast("string")) for k in range(12)]).alias("text"))
    few, many = fresh_path(spark, "few"), fresh_path(spark, "many")
    search.build_index(df, "id", ["text"], few)
    search.build_index(df, "id", ["text"], many, folder_bytes=8 << 10)
    folders = [spark.read.parquet(f"{p}/size").first()[0] for p in (few, many)]
    assert folders[0] == 1 and folders[1] >= 16
    a, b = (search.search(spark, p, "w3 w7 w90", 15).collect() for p in (few, many))
    assert a == b and len(a) == 15
    assert search.matching(spark, many, "w3 w7").exceptAll(search.matching(spark, few, "w3 w7")).isEmpty()


# --- checks that a wrong model does not pass --------------------------------------------------------------

def test_fit_is_refused_for_constants_and_noise(spark, sf_dir):
    rows = learn.sloped(Tables(spark, sf_dir))
    mean = rows.agg(F.avg("amount")).first()[0]
    for wrong in (F.lit(mean), F.lit(0.0), F.rand(1) * 400, F.lit(None).cast("double")):
        assert learn.explained(rows.withColumn("prediction", wrong)).first()["fits"] is False


def test_clusters_are_refused_for_constants_noise_and_untrained_centres(spark, sf_dir):
    rows = learn.blobs(Tables(spark, sf_dir), 3)
    right = learn.told_apart(rows.withColumn("prediction", (F.col("blob") + 1) % 3), "blob", 3).first()
    assert right["told_apart"] is True and right["n"] == rows.count()
    for wrong in (F.lit(1), F.floor(F.rand(1) * 3), F.col("event_id") % 2, F.lit(None).cast("int")):
        assert learn.told_apart(rows.withColumn("prediction", wrong), "blob", 3).first()["told_apart"] is False
    near = clustering.assigned(rows, ["x", "y"], [[0.0, 0.1], [0.0, 0.0], [0.1, 0.0]])
    assert learn.told_apart(near, "blob", 3).first()["told_apart"] is False


def test_prediction_of_seen_rows_does_not_count(spark, sf_dir):
    rows = learn.sloped(Tables(spark, sf_dir))
    learned_by_heart = F.when(~F.col("held"), F.col("amount")).otherwise(F.lit(0.0))
    assert learn.explained(rows.withColumn("prediction", learned_by_heart)).first()["fits"] is False


def test_grid_of_many_dates(spark, monkeypatch):
    from sparkdeck.operators import series

    monkeypatch.setattr(series, "DATES", 3)
    df = spark.createDataFrame([(p, d, 1.0) for p in range(4) for d in range(20) if (p + d) % 3], "p long, d long, v double")
    out = series.complete(df, "p", "d")
    assert out.count() == 80 and out.filter("v is null").count() == 80 - df.count() and out.columns == ["p", "d", "v"]


def test_too_many_ids_raise(spark, monkeypatch):
    from sparkdeck.operators import recommend

    rows = spark.range(10).select(F.col("id").alias("user"))
    assert recommend.dense_ids(rows, "user").agg(F.max("_user")).first()[0] == 10
    monkeypatch.setattr(recommend, "MOST_IDS", 9)
    with pytest.raises(Exception, match="too many distinct"):
        recommend.dense_ids(rows, "user")
