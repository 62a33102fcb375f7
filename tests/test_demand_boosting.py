"""Demand preparation by hand, and boosting for several classes."""

import random

import numpy as np
from pyspark.sql import functions as F

from sparkdeck.operators import demand, features
from sparkdeck.operators.models import classification as cls


def test_prepared_articles_by_hand(spark):
    columns = "article long, collection int, colour string, family string, age long, price double, first_day string, key long"
    rows = [
        (1, 2000, "red", "a", 1, 10.0, "01/02/2000", 1), (1, 2001, "red", "a", 1, 20.0, "15/05/2001", 9), (1, 2002, "red", "a", 1, 99.0, "30/09/2002", None),
        (2, 2000, "red", "a", 1, 30.0, "31/12/2000", 1), (2, 2002, "red", "a", 1, 5.0, "01/01/2002", 1), (3, 2001, "blue", "a", 1, 40.0, "99/99/2001", 1),
        (4, 1990, "red", "a", 1, 1.0, "01/01/1990", 1),
    ]
    orders = [(1, 2000, "R", 4), (1, 2000, "R", 2), (1, 2000, "N", 100), (2, 2000, "R", 10), (1, 2002, "R", 77), (1, 2001, "N", 5)]
    dim = spark.createDataFrame([(1, "north")], "key long, name string")
    learn, pred = demand.prepare_articles(
        spark.createDataFrame(rows, columns), spark.createDataFrame(orders, "article long, collection int, kind string, qty long"),
        [(dim, "key", "name", "origin")], [2000, 2001], [2002],
    )
    shown = lambda df: {(r.article, r.collection): (r.sold, r.quarter, r.origin, r.price_bin, r.ref_code, r.ref_kind) for r in df.collect()}
    # the row without a readable day is gone; cuts of the prices 10, 20, 30 are 15, 20 and 25
    assert shown(learn) == {(1, 2000): (6.0, 1, "north", 1, 0.0, 0.0), (2, 2000): (10.0, 4, "north", 4, 0.0, 0.0), (1, 2001): (0.0, 2, "other", 2, 6.0, 8.0)}
    # sales of the collection to predict are nobody's reference
    assert shown(pred) == {(1, 2002): (77.0, 3, "other", 4, 3.0, 16 / 3), (2, 2002): (0.0, 1, "north", 1, 10.0, 16 / 3)}


def three_classes(spark, n=600, noise=0.0):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        x, y, z = rng.random(), rng.random(), rng.random()
        label = 0 if x < 0.4 else 1 if y < 0.5 else 2
        rows.append((k, float(label if rng.random() >= noise else rng.randrange(3)), x, y, z))
    return features.assemble(spark.createDataFrame(rows, "id long, label double, x double, y double, z double"), ["x", "y", "z"])


def test_boosting_finds_three_classes_and_stops(spark):
    rows = three_classes(spark)
    model = cls.boosted_classes(rows, "id", rounds=4, rate=0.8, depth=2)
    scored = model.transform(rows)
    assert set(scored.columns) == {*rows.columns, "prediction", "probability"}
    found = scored.select("label", "prediction", "probability").collect()
    assert np.mean([r.label == r.prediction for r in found]) > 0.95
    assert all(abs(sum(r.probability) - 1) < 1e-9 and int(np.argmax(r.probability)) == r.prediction for r in found)
    losses = [h for _, _, h in model.curve]
    assert losses == sorted(losses, reverse=True) and len(model.rounds) == len(losses) == 4
    again = cls.boosted_classes(rows.repartition(5), "id", rounds=4, rate=0.8, depth=2)
    assert np.allclose([h for _, _, h in again.curve], losses)


def test_boosting_stops_where_held_out_rows_do_not_gain(spark):
    noise = three_classes(spark, 200, noise=1.0)
    model = cls.boosted_classes(noise, "id", rounds=8, rate=1.0, depth=5, patience=2, column_share=0.5)
    assert len(model.curve) < 8 and len(model.rounds) == min(range(len(model.curve)), key=lambda k: model.curve[k][2]) + 1
    assert cls.learning_curve(spark, model).count() == len(model.curve)
    assert all(len(names) == 2 for trees in model.rounds for names, _ in trees)
