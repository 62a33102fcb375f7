import math
import random

from pyspark.sql import functions as F

from sparkdeck.operators import neighbours as nb


def brute(points, k):
    out = []
    for i, p in enumerate(points):
        d = sorted(math.dist(p, q) for j, q in enumerate(points) if i != j)
        out.append(d[min(k, len(d)) - 1])
    return out


def check(spark, points, k):
    cols = [f"x{i}" for i in range(len(points[0]))]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in cols))
    got = {r.id: r.dist for r in nb.kth_distance(df, "id", cols, k).collect()}
    want = brute([tuple(map(float, p)) for p in points], k)
    assert len(got) == len(points)
    assert all(math.isclose(got[i], w, abs_tol=1e-12) for i, w in enumerate(want))


def test_uneven_cloud(spark):
    rng = random.Random(1)
    points = [(rng.gauss(0, 0.001), rng.gauss(0, 0.001)) for _ in range(60)] + [(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(60)]
    check(spark, points, 4)


def test_copies_and_outliers(spark):
    check(spark, [(0, 0)] * 9 + [(1, 1)] * 3 + [(500, 500), (0, 0.5), (1, 1.25)], 3)


def test_three_dimensions_and_few_rows(spark):
    rng = random.Random(2)
    check(spark, [(rng.random(), rng.random(), rng.random()) for _ in range(40)], 5)
    check(spark, [(0, 0), (3, 4), (6, 8)], 5)


def test_oversampling(spark):
    rng = random.Random(3)
    rows = [(i, 1, rng.random(), rng.random()) for i in range(30)] + [(100 + i, 0, 5 + rng.random(), rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, label int, x double, y double")
    out = nb.oversample(df, "id", ["x", "y"], "label", 1, over=2, under=3.0, k=3).collect()
    new = [r for r in out if r.synthetic]
    assert len(new) == 60 and all(r.label == 1 for r in new)
    assert sum(r.label == 1 and not r.synthetic for r in out) == 30
    assert abs(sum(r.label == 0 for r in out) - 180) < 45
    few = [(x, y) for _, label, x, y in rows if label == 1]
    for r in new:  # every new row lies on a line between two minority rows
        on = any(
            abs(math.dist(p, (r.x, r.y)) + math.dist((r.x, r.y), q) - math.dist(p, q)) < 1e-9 for p in few for q in few if p != q
        )
        assert on
    assert df.filter(F.col("label") == 1).count() == 30


def test_no_side_of_the_grid_joins_is_broadcast(spark, monkeypatch):
    """A row per level is many times what the planner takes the points for, so a broadcast fills the driver."""
    plans = []

    def spy(df, name="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    kept = nb.stored
    monkeypatch.setattr(nb, "stored", spy)
    rng = random.Random(9)
    rows = [(i, rng.random(), rng.random(), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, y double, label int")
    outs = [nb.kth_distance(df, "id", ["x", "y"], 5), nb.oversample(df, "id", ["x", "y"], "label", 1, over=2, under=1.5)]
    plans += [out._jdf.queryExecution().executedPlan().toString() for out in outs]
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
