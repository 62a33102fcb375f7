import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.operators import features, recommend, relational as rel, stats
from sparkdeck.operators.models import anomaly, classification as cls, clustering, regression, tuning
from sparkdeck.plans import learn
from sparkdeck.plans.views import Tables


def blobs(spark, centres, n, spread=0.05, seed=1):
    rng = random.Random(seed)
    rows = [(i, float(c), x + rng.gauss(0, spread), y + rng.gauss(0, spread)) for i, (c, (x, y)) in enumerate((c, p) for c, p in enumerate(centres) for _ in range(n))]
    return spark.createDataFrame(rows, "id int, label double, x double, y double")


CENTRES = [(0.0, 0.0), (5.0, 0.0), (0.0, 5.0)]


def test_classifiers_separate_blobs(spark):
    rows = features.assemble(blobs(spark, CENTRES, 40), ["x", "y"])
    for model in (cls.logistic(rows, iters=30), cls.tree(rows), cls.forest(rows, trees=5, depth=4), cls.perceptron(rows, [2, 6, 3])):
        assert cls.metric(model.transform(rows)) > 0.95
    two = rows.filter("label < 2")
    assert cls.metric(cls.boosted(two, trees=3).transform(two)) > 0.95


def test_linear_recovers_coefficients(spark):
    rng = random.Random(4)
    rows = [(float(a), float(b), 3.0 * a - 2.0 * b + 7 + rng.gauss(0, 0.01)) for a in range(12) for b in range(12)]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"])
    model = regression.linear(df, "y", iters=50, reg=0.0, elastic=0.0)
    assert np.allclose(model.coefficients.toArray(), [3, -2], atol=0.01) and abs(model.intercept - 7) < 0.05
    names = {r.name for r in regression.training_summary(spark, model).collect()}
    assert {"iterations", "rmse", "r2", "objective"} <= names


def test_gradient_descent_equals_loop(spark):
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(60, 2)), np.zeros(2)
    y = x @ [1.5, -0.5]
    for t in range(1, 41):
        w = w - 0.1 / math.sqrt(t) * (x.T @ (x @ w - y)) / len(x)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    assert np.allclose(regression.gradient_descent(df, ["a", "b"], "y", 0.1, 40), w)


def test_kmeans_and_elbow(spark):
    rows = features.assemble(blobs(spark, CENTRES, 30), ["x", "y"])
    models, table = clustering.sweep(rows, [3, 2, 10])
    costs = [r.wssse for r in table.orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True) and [r.k for r in table.collect()] == [2, 3, 10]
    assert stats.align_clusters(models[3].transform(rows), "prediction", "label").count() == 3


def brute_clusters(points, eps, minimum):
    near = [[j for j, q in enumerate(points) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in points]
    core = [len(n) >= minimum for n in near]
    part = list(range(len(points)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, n in enumerate(near):
        for j in n:
            if core[i] and core[j]:
                part[find(i)] = find(j)
    return core, [find(i) if core[i] else None for i in range(len(points))], near


def check_density(spark, points, eps, minimum):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    got = {r.id: (r.core, r.cluster) for r in clustering.density_clusters(df, "id", ["x", "y"], eps, minimum).collect()}
    core, root, near = brute_clusters(points, eps, minimum)
    assert [got[i][0] for i in range(len(points))] == core
    seen = {}
    for i in range(len(points)):
        if core[i]:
            assert seen.setdefault(root[i], got[i][1]) == got[i][1]
        else:
            reach = {got[j][1] for j in near[i] if core[j]}
            assert got[i][1] in reach if reach else got[i][1] == "-1"
    assert len(set(seen.values())) == len(seen)


def test_density_clusters_equal_brute_force(spark):
    for seed, eps, minimum in ((1, 0.5, 4), (2, 0.9, 3), (3, 0.35, 5)):
        rng = random.Random(seed)
        points = [(rng.gauss(c, 0.6), rng.gauss(-c, 0.6)) for c in (0, 3) for _ in range(70)]
        points += [(rng.uniform(-4, 6), rng.uniform(-6, 4)) for _ in range(30)]
        check_density(spark, points, eps, minimum)


def test_density_clusters_with_a_hot_spot_and_a_near_miss(spark):
    points = [(0.0, 0.0)] * 60 + [(1.0, 0.0)] * 3 + [(1.0, 1.0)] * 40 + [(2.001, 1.0)] * 40
    check_density(spark, points, 1.0, 4)


def test_components_of_a_long_shuffled_chain(spark):
    names = list(range(500))
    random.Random(8).shuffle(names)
    edges = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in zip(names, names[1:]) if names.index(a) != 299], "a int, b int")
    out = clustering.components(spark.range(500).selectExpr("cast(id as int) node"), edges)
    want = {n: min(names[:300]) for n in names[:300]} | {n: min(names[300:]) for n in names[300:]}
    assert {r.node: r.root for r in out.collect()} == want


def test_isolation_ranks_planted_outliers_first(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(600)] + [(600 + i, 9.0 + i, -9.0) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    forest = anomaly.isolation_forest(df, "id", ["a", "b"], trees=40)
    scored = anomaly.isolation_scores(df, ["a", "b"], forest)
    assert {r.id for r in scored.orderBy(F.col("score").desc()).limit(4).collect()} == {600, 601, 602, 603}


def test_splits_are_disjoint_and_repeatable(spark):
    df = spark.range(5000)
    parts = rel.split_by_hash(df, "id", [0.7, 0.2, 0.1], seed=9)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and abs(sizes[0] - 3500) < 200 and abs(sizes[2] - 500) < 120
    assert parts[0].intersect(parts[1]).count() == 0
    again = rel.split_by_hash(df.repartition(7), "id", [0.7, 0.2, 0.1], seed=9)
    assert again[0].exceptAll(parts[0]).count() == 0


def test_factors_fit_low_rank_ratings(spark):
    rng = np.random.default_rng(2)
    scores = rng.uniform(0.5, 1.5, (30, 2)) @ rng.uniform(0.5, 1.5, (2, 20))
    rows = [(u, i, float(scores[u, i])) for u in range(30) for i in range(20) if (u * 7 + i) % 5]
    held = [(u, i, float(scores[u, i])) for u in range(30) for i in range(20) if (u * 7 + i) % 5 == 0]
    schema = "user_id int, item_id int, rating double"
    model = recommend.train(spark.createDataFrame(rows, schema), rank=3, iters=10, reg=0.01)
    error = recommend.pair_error(model, spark.createDataFrame([*held, (999, 1, 1.0)], schema)).first()
    assert error.rmse < 0.2 and error.n == len(held)
    best = model.recommend(3, spark.createDataFrame([(4,)], "user_id int")).orderBy("rank").collect()
    assert [r["rank"] for r in best] == [1, 2, 3] and best[0].score >= best[2].score


def test_newsletter_rules(spark):
    scores = spark.createDataFrame([("1", 10, 4.0), ("1", 11, 1.0), ("2", 10, 2.0)], "uid string, index bigint, score double")
    offered = spark.createDataFrame([(u, i, 1.0 - i / 100) for u in ("1", "2") for i in (10, 11, 12, 13)], "uid string, index bigint, score double")
    emails = spark.createDataFrame([(1, "a@x")], "id bigint, email string")
    stock = spark.createDataFrame([(i, f"p{i}") for i in (10, 11, 12, 13)], "index bigint, pid string")
    out = recommend.newsletter(scores, offered, emails, stock, 2)
    assert sorted((r.email, r.uid, r.pid) for r in out.collect()) == [("a@x", "1", "p11"), ("a@x", "1", "p12")]
    assert [r.uid for r in recommend.mailed(scores, emails).collect()] == ["1"]


def test_ids_of_any_size_and_type(spark):
    """Users beyond 2^53 and text items keep their names."""
    rows = [(2**60 + u, f"item{i}", 5.0 if (u + i) % 2 else 1.0) for u in range(12) for i in range(10) if (u * 3 + i) % 4]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id string, rating double")
    model = recommend.train(ratings, rank=3, iters=8, reg=0.01)
    best = model.recommend(4, ratings.filter(F.col("user_id") == 2**60 + 1).select("user_id")).collect()
    assert {r.user_id for r in best} == {2**60 + 1} and {int(r.item_id[4:]) % 2 for r in best} == {0}


def test_whole_numbers_are_not_numbered_again(spark, monkeypatch):
    """Ids that the library takes go in as they are; beyond its range, or of another type, they are numbered."""
    rows = [(u * 1000, 2**31 - 1 - i, 5.0 if (u + i) % 2 else 1.0) for u in range(12) for i in range(10) if (u * 3 + i) % 4]
    ratings = spark.createDataFrame([*rows, (None, 5, 1.0), (7, None, 1.0)], "user_id bigint, item_id int, rating double")
    wide = ratings.withColumn("user_id", F.col("user_id") + 2**33)
    named = []
    numbered = recommend.dense_ids
    monkeypatch.setattr(recommend, "dense_ids", lambda rows, name: named.append(name) or numbered(rows, name))
    model = recommend.train(ratings, rank=3, iters=8, reg=0.01)
    assert not named
    known = {(u, i) for u, i, _ in rows}
    scored = model.predict(ratings)
    assert {(r.user_id, r.item_id) for r in scored.collect()} == known and dict(scored.dtypes)["user_id"] == "bigint"
    assert all(abs(r.prediction - r.rating) < 1.5 for r in scored.collect())
    assert {r.user_id for r in model.recommend(2).collect()} == {u for u, _ in known}
    recommend.train(wide, rank=3, iters=1)
    assert named == ["user_id"]
    recommend.train(ratings.withColumn("item_id", F.col("item_id").cast("string")), rank=3, iters=1)
    assert named == ["user_id", "item_id"]


def test_blocks_of_the_model_follow_cores_and_ratings(spark, monkeypatch):
    """Many shuffle partitions alone do not make many blocks, each of which needs factors of its own."""
    ratings = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(9)], "user_id int, item_id int, rating double")
    made, library = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **given: made.append((given["numUserBlocks"], given["numItemBlocks"])) or library(**given | {"numUserBlocks": 2, "numItemBlocks": 2}))
    held, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        recommend.train(ratings, rank=2, iters=1)
        monkeypatch.setattr(recommend, "PER_BLOCK", 3)
        recommend.train(ratings, rank=2, iters=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert made == [(cores, cores), (max(cores, 27),) * 2]


def test_blocks_and_factors_of_the_model_are_not_kept_on_the_heap(spark, monkeypatch):
    ratings = spark.createDataFrame([(u, i, 1.0 + (u + i) % 5) for u in range(9) for i in range(9)], "user_id int, item_id int, rating double")
    made, library = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **given: made.append(library(**given)) or made[-1])
    model = recommend.train(ratings, rank=2, iters=1)
    assert [(a.getIntermediateStorageLevel(), a.getFinalStorageLevel()) for a in made] == [("DISK_ONLY", "DISK_ONLY")]
    kept = [x for x in spark.sparkContext._jsc.sc().getRDDStorageInfo() if x.name() in ("userFactors", "itemFactors") and x.diskSize() > 0]
    assert len(kept) >= 2 and model.predict(ratings).count() == 81


def test_latest_known_user_per_visitor(spark):
    clicks = spark.createDataFrame([("v", "0", 9), ("v", "7", 3), ("v", "8", 5), ("w", "0", 1)], "vid string, uid string, vts_last int")
    assert [tuple(r) for r in recommend.known_visitors(clicks).collect()] == [("v", "8")]


def test_same_idf_model_for_train_and_test(spark):
    train = spark.createDataFrame([(["a", "b"],), (["a"],)], "words array<string>")
    model = features.hashed_tf_idf(train, "words", 64)
    row = features.weigh(train.limit(1), "words", model, 64).first()
    assert row.features.numNonzeros() >= 1


def test_search_and_random_settings(spark):
    assert len(tuning.draws({"a": [1, 2], "b": [3]}, 5)) == 5 and tuning.draws({"a": [1, 2]}, 3, 7) == tuning.draws({"a": [1, 2]}, 3, 7)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, s double")
    assert abs(stats.auc(df, "y", "s").first().auc - 0.875) < 1e-12
    best = stats.best_threshold(df, "y", "s").first()
    assert (best.threshold, best.tpr, best.fpr) == (0.9, 0.5, 0.0)
    ranks = stats.average_ranks(spark.createDataFrame([(1,), (3,), (3,), (9,)], "v int"), "v", "r")
    assert sorted(r.r for r in ranks.collect()) == [1.0, 2.5, 2.5, 4.0]
    report = {r["class"]: r for r in stats.classification_report(spark.createDataFrame([(1, 1), (1, 0), (2, 3)], "y int, p int"), "y", "p").collect()}
    assert report[1].precision == 1.0 and report[1].recall == 0.5 and report[3].support == 0 and report[0].precision == 0.0


def test_two_stage_scores(spark):
    rows = [(float(i), float(i % 2), 10.0 * i if i % 2 else 0.0) for i in range(60)]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double, q double"), ["a", "b"])
    score, fit = cls.two_stage(df, "q", trees=5)
    out = score(df).collect()
    assert all(r.expected == 0 for r in out if r.b == 0) and fit > 0.5


# --- checks that a wrong model must not pass ----------------------------------------------------------

def test_quality_refuses_constant_random_and_no_predictions(spark, sf_dir):
    rows = learn.planted(Tables(spark, sf_dir))
    for wrong in (F.lit(0.0), F.floor(F.rand(1) * 4).cast("double")):
        assert learn.quality(rows.withColumn("prediction", wrong)).first().good is False
    assert learn.quality(rows.withColumn("prediction", F.col("label"))).first().good is True
    empty = learn.quality(rows.limit(0).withColumn("prediction", F.lit(0.0))).first()
    assert (empty.n, empty.good) == (0, False)


def test_search_figures_refuse_what_does_not_learn(spark):
    def table(metrics):
        return spark.createDataFrame([(f"s{k}", float(m)) for k, m in enumerate(metrics)], "setting string, metric double")

    assert tuple(learn.searched(table([0.95, 0.5, 0.7, 0.95])).first()) == (4, True, True)
    assert tuple(learn.searched(table([0.3, 0.3, 0.3, 0.3])).first()) == (4, False, False)
    assert learn.searched(table([])).first().n == 0


def test_lists_of_a_constant_recommender_are_refused(spark):
    same = [(u, i, 1.0, i) for u in (1, 2) for i in range(1, 21)]
    rows = spark.createDataFrame(same, "user_id bigint, item_id bigint, score double, rank int")
    assert {r.n_liked for r in learn.judged(rows).collect()} == {10}
    rising = rows.withColumn("score", F.col("rank").cast("double"))
    assert not any(r.falling for r in learn.judged(rising).collect())


def test_best_items_equal_brute_force_over_blocks(spark, monkeypatch):
    """Users and items in several blocks, products in several steps: the same lists as all products at once, without a product of tables."""
    rng = random.Random(12)
    rows = [(u, i, float(1 + 4 * (u % 3 == i % 3))) for u in range(60) for i in range(90) if rng.random() < 0.3]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        model = recommend.train(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), rank=4, iters=3)
        assert model.model.userFactors.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for name, value in (("USERS", 16), ("ITEMS", 25), ("ROWS", 5), ("COLUMNS", 7)):
        monkeypatch.setattr(recommend, name, value)
    best = model.recommend(9)
    assert "CartesianProduct" not in best._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in best.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    names = {side: {r[1]: r[0] for r in table.collect()} for side, table in (("u", model.users), ("i", model.items))}
    items = [(names["i"][r.id], r.features) for r in model.model.itemFactors.collect()]
    users = [(names["u"][r.id], r.features) for r in model.model.userFactors.collect()]
    assert len(got) == len(users) == 60
    for user, own in users:
        scores = {item: sum(a * b for a, b in zip(own, other)) for item, other in items}
        want = sorted(scores.values(), reverse=True)[:9]
        assert [s for _, s in got[user]] == pytest.approx(want, abs=1e-4)
        assert all(abs(scores[i] - s) < 1e-4 for i, s in got[user]) and len({i for i, _ in got[user]}) == 9
    pairs = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    held = {(u, i): sum(a * b for a, b in zip(own, other)) for u, own in users for i, other in items}
    assert all(abs(r.prediction - held[r.user_id, r.item_id]) < 1e-4 for r in model.predict(pairs).collect())


def test_boosting_deals_rows_over_the_cores(spark, monkeypatch):
    """A small file is one task: without dealing, all rounds run in it."""
    parts = []

    def spy(df, name="stage"):
        out = kept(df, name)
        parts.append(out.sparkSession.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).select(F.input_file_name()).distinct().count())
        return out

    kept = cls.stored
    monkeypatch.setattr(cls, "stored", spy)
    rows = [(k, k % 7 / 7, k % 5 / 5, float(k % 7 > 3)) for k in range(400)]
    df = spark.createDataFrame(rows, "key long, a double, b double, label double").coalesce(1)
    cls.boosted_classes(features.assemble(df, ["a", "b"]), "key", rounds=1)
    assert min(parts) > 1
