import re
import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sparkdeck.session import fresh_path
from sparkdeck.operators import search, similarity


def brute(docs, min_sim):
    m = len(docs)
    df = Counter(w for words in docs.values() for w in set(words))
    vec = {}
    for i, words in docs.items():
        w = {t: n * math.log((m + 1) / (df[t] + 1)) for t, n in Counter(words).items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        vec[i] = {t: v / norm for t, v in w.items()} if norm else {}
    sims = {}
    for a in docs:
        for b in docs:
            if a < b:
                s = sum(v * vec[b].get(t, 0) for t, v in vec[a].items())
                if s >= min_sim:
                    sims[a, b] = s
    return sims


def pairs_over_all(spark, docs, min_sim):
    df = spark.createDataFrame([(i, w) for i, w in docs.items()], "id int, words array<string>")
    return df, similarity.similar_documents(df, "id", "words", min_sim)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), min_sim=st.sampled_from([0.1, 0.3, 0.6, 0.9]))
def test_pairs_equal_brute_force(spark, seed, min_sim):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)]
    docs = {i: [rng.choice(words[: rng.choice([3, 14])]) for _ in range(rng.randint(1, 9))] for i in range(25)}
    _, (groups, pairs) = pairs_over_all(spark, docs, min_sim)
    rep = {r.id: r.rep for r in groups.collect()}
    got = {(r.a, r.b): r.sim for r in pairs.collect()}
    want = {k: v for k, v in brute(docs, min_sim).items() if abs(v - min_sim) > 1e-6 and rep[k[0]] == k[0] and rep[k[1]] == k[1]}
    assert want.keys() <= got.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert all(v >= min_sim - 1e-9 for v in got.values())


def test_most_similar_with_a_large_group_of_copies(spark):
    docs = {i: ["hot", "pan"] for i in range(30)}
    docs |= {100 + i: ["hot", "pan", f"x{i}"] for i in range(5)} | {200: ["other"], 201: ["other"]}
    _, (groups, pairs) = pairs_over_all(spark, docs, 0.05)
    rounded = pairs.withColumn("sim", F.round("sim", 9))
    got = {}
    for r in similarity.most_similar(groups, rounded, 4).collect():
        got.setdefault(r.id, []).append((r["rank"], r.other))
    sims = brute(docs, 0.05)
    for i in docs:
        near = [(-round(s, 9), b if a == i else a) for (a, b), s in sims.items() if i in (a, b)]
        want = [o for _, o in sorted(near)[:4]]
        assert [o for _, o in sorted(got.get(i, []))] == want, i


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000))
def test_nearest_documents_have_no_floor(spark, seed):
    """Lists are full although most pairs are far below 0.4, over several blocks, with copies and strangers."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    docs = {i: rng.sample(words, rng.randint(1, 9)) for i in range(40)}
    docs |= {50 + i: docs[i] for i in range(3)} | {90: ["alone"], 91: []}
    df = spark.createDataFrame([(i, w) for i, w in docs.items()], "id int, words array<string>")
    sims = brute(docs, 1e-12) | {(i, 50 + i): 1.0 for i in range(3)}
    old = similarity.BLOCK, similarity.PRODUCTS, similarity.COLUMNS
    similarity.BLOCK, similarity.PRODUCTS, similarity.COLUMNS = 12, 50, 3
    try:
        got = {}
        for r in similarity.nearest_documents(df, "id", "words", 4).collect():
            got.setdefault(r.id, []).append((r["rank"], r.other, r.sim, r.found))
    finally:
        similarity.BLOCK, similarity.PRODUCTS, similarity.COLUMNS = old
    low = 0
    for i in docs:
        near = sorted((-round(s, 9), b if a == i else a) for (a, b), s in sims.items() if i in (a, b))[:4]
        assert [(o, -s, len(near)) for s, o in near] == [(o, round(s, 9), f) for _, o, s, f in sorted(got.get(i, []))], i
        low += sum(-s < 0.4 for s, _ in near)
    assert low > 0 and 90 not in got


def test_blocks_meet_in_place(spark, monkeypatch):
    """Documents in many blocks and batches: every pair once, and no document is shuffled to its blocks."""
    rng = random.Random(5)
    docs = {i: [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))] for i in range(60)} | {70: list("abcdefghijklmnop") * 2}
    for name, value in (("BLOCK", 7), ("ENTRIES", 14), ("STEP", 3)):
        monkeypatch.setattr(similarity, name, value)
    held = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, (groups, pairs) = pairs_over_all(spark, docs, 0.2)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        got = pairs.collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert "CartesianProduct" in plan and "Exchange" not in plan, plan
    rep = {r.id: r.rep for r in groups.collect()}
    want = {k: s for k, s in brute(docs, 0.2).items() if rep[k[0]] == k[0] and rep[k[1]] == k[1]}
    assert len(got) == len(want) > 100 and all(abs(want[r.a, r.b] - r.sim) < 1e-9 for r in got)


def test_a_task_offers_k_rows_for_a_document(spark, monkeypatch):
    """However many blocks meet in a task; an entry is two small numbers; ids and texts may repeat or be missing."""
    rng = random.Random(8)
    docs = {i: [rng.choice("abcdefghijklmnopqrstuv") for _ in range(rng.randint(2, 9))] for i in range(60)}
    docs |= {70 + i: docs[i] for i in range(3)}
    for name, value in (("BLOCK", 5), ("STEP", 2), ("OFFERS", 30)):
        monkeypatch.setattr(similarity, name, value)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # all blocks meet in one task
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, w[:1]) for i, w in docs.items() if i < 70] + [(i, w[1:]) for i, w in docs.items() if i < 70]
        texts = spark.createDataFrame([*docs.items(), (None, ["a"]), (80, None)], "id int, words array<string>")
        groups, blocks = similarity.representatives(texts, "id", "words")
        packed = blocks.collect()
        offers = similarity.nearest(blocks, "int", 3, 9)
        tasks, offers = offers.rdd.getNumPartitions(), offers.collect()
        _, split = similarity.representatives(spark.createDataFrame(rows, "id int, words array<string>"), "id", "words")
        ids = [i for r in split.collect() for i in memoryview(r.ids).cast("q")]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        for k, v in held.items():
            spark.conf.set(k, v)
    rep = {r.id: r.rep for r in groups.filter("id IS NOT NULL").collect()}
    sims = {k: s for k, s in brute(docs | {80: [], 81: []}, 1e-12).items() if rep.get(k[0]) == k[0] and rep.get(k[1]) == k[1]}
    want = set()
    for i in (i for i in docs if rep[i] == i):
        near = sorted((-round(s, 9), b if a == i else a) for (a, b), s in sims.items() if i in (a, b))[:3]
        want |= {(i, o, -s) for s, o in near}
    assert tasks == 1 and len(packed) > 10, tasks
    assert {(r.a, r.b, r.sim) for r in offers} == want and len(offers) == len(want)
    assert all(len(r.numbers) == len(r.tf) == 4 * sum(memoryview(r.sizes).cast("i")) for r in packed)
    assert len(ids) == len(set(ids)) > 20


def test_documents_of_a_block_stand_by_kind(spark, monkeypatch):
    """Two vocabularies in turn: no step of a block mixes them, and the pairs are those of all documents."""
    rng = random.Random(3)
    words = [[f"{side}{i}" for i in range(12)] for side in "xy"]
    docs = {i: [*rng.sample(words[i % 2], 6), f"own{i}"] for i in range(80)}
    for name, value in (("BLOCK", 40), ("STEP", 8)):
        monkeypatch.setattr(similarity, name, value)
    df = spark.createDataFrame(list(docs.items()), "id int, words array<string>")
    _, blocks = similarity.representatives(df, "id", "words")
    packed, mixed, steps = blocks.collect(), 0, 0
    for row in packed:
        side = similarity._Side(SimpleNamespace(**{f"l_{c}": row[c] for c in blocks.columns}), "l")
        for step in side.steps(np.arange(len(side.names)), 8, False):
            mixed += len({int(i) % 2 for i in step.ids}) > 1
            steps += 1
    got = {(r.a, r.b): r.sim for r in similarity.cosine_pairs(blocks, "int", 0.3).collect()}
    want = brute(docs, 0.3)
    assert mixed == 0 and steps >= 10, (mixed, steps)
    assert got.keys() == want.keys() and len(got) > 100 and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_all_pairs_are_compared_once_however_often_lists_are_read(spark):
    df = spark.createDataFrame([(i, ["a", f"w{i % 3}", f"x{i}"]) for i in range(9)], "id int, words array<string>")
    lists = similarity.nearest_documents(df, "id", "words", 2)
    assert "MapInPandas" not in lists._jdf.queryExecution().toString() and lists.count() == 18


def test_only_the_pairs_have_a_floor():
    from sparkdeck.plans import CHECKS

    assert "0.4" in CHECKS["n07_cosine_pairs"] and "0.4" not in CHECKS["n08_most_similar"]


def test_search_scores_grow_with_matches(spark):
    rows = [(1, "red ring", "x"), (2, "red red ring", "y"), (3, "blue ring", "red"), (4, "blue", "z")]
    df = spark.createDataFrame(rows, "id int, a_label string, b_label string")
    path = fresh_path(spark, "index")
    search.build_index(df, "id", ["a_label", "b_label"], path)
    out = search.search(spark, path, "Red", 10).collect()
    assert {r.id for r in out} == {1, 2, 3}
    score = {r.id: r.score for r in out}
    assert score[2] > score[1]
    assert {r.id for r in search.matching(spark, path, "blue z").collect()} == {3, 4}
    assert search.search(spark, path, "nothing", 5).count() == 0
    plan = search.search(spark, path, "red blue", 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ IN \(|PartitionFilters: \[.*bucket#\d+ = ", plan), plan
