"""Statistics, feature preparation and evaluation figures."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.scalar import right_closed
from ..operators import features, neighbours, ordered, relational as rel, similarity, stats
from ..session import stored
from .groups import _ITEM_MEAN, with_item_mean
from .registry import query
from .text import STOP_WORDS, _CATALOGUE_SQL

COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _moment_sql(c):
    return f"""SELECT '{c}' AS name, round(avg({c}), 4) AS mean, round(var_samp({c}), 4) AS variance,
                      CAST(sum(CASE WHEN {c} <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonzero FROM lineitem"""


@query("k01_column_moments", " UNION ALL ".join(map(_moment_sql, COLS)))
def column_moments(t):
    out = stats.moments(t.lineitem, COLS)
    return out.select("name", F.round("mean", 4).alias("mean"), F.round("variance", 4).alias("variance"), "nonzero")


def _pairs_sql(fn, source, digits=6):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round({fn}({a}, {b}), {digits}) AS value FROM {source}"
        for i, a in enumerate(COLS)
        for b in COLS[i:]
    )


@query("k02_correlation", _pairs_sql("corr", "lineitem"))
def correlation(t):
    return stats.corr_matrix(t.lineitem, COLS).withColumn("value", F.round("value", 6))


_RANKS = (
    "(SELECT "
    + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in COLS)
    + " FROM lineitem)"
)


@query("k02_rank_correlation", _pairs_sql("corr", _RANKS))
def rank_correlation(t):
    return stats.corr_matrix(t.lineitem, COLS, "spearman").withColumn("value", F.round("value", 6))


def _summary_sql(c):
    return f"""SELECT '{c}' AS name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}, 0.25), 4) AS q1,
        round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem"""


@query("k04_summary", " UNION ALL ".join(_summary_sql(c) for c in COLS))
def summary(t):
    out = stats.summary(t.lineitem, COLS)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q1", "median", "q3")})


@query(
    "k05_quartiles_by_class",
    """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS q2,
              round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY 1""",
)
def quartiles_by_class(t):
    out = ordered.quantiles(t.events, ["event_type"], "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3")])


@query(
    "k06_neighbour_distances",
    """SELECT a.event_id AS id, round(sqrt(min((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat), 6)[6]), 8) AS dist
       FROM v_points a, v_points b GROUP BY a.event_id""",
)
def neighbour_distances(t):
    out = neighbours.kth_distance(t.v_points, "event_id", ["lon", "lat"], 5)
    return out.withColumn("dist", F.round("dist", 8))


@query(
    "k07_label_baselines",
    """SELECT round(max(n) / sum(n), 8) AS majority, round(sum(n * n) / (sum(n) * sum(n)), 8) AS shuffled,
              round(1.0 / count(*), 8) AS uniform FROM (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY 1)""",
)
def label_baselines(t):
    out = stats.baselines(t.embeddings, "label")
    return out.select(*[F.round(c, 8).alias(c) for c in ("majority", "shuffled", "uniform")])


@query(
    "l01_assembled_vectors",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity + l_discount AS total FROM lineitem""",
)
def assembled_vectors(t):
    rows = features.assemble(t.lineitem, ["l_quantity", "l_discount"])
    v = vector_to_array("features")
    return rows.select("l_partkey", "l_orderkey", "l_linenumber", (v[0] + v[1]).alias("total"))


@query(
    "l02_standardise",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - m) / s, 6) AS q FROM lineitem,
         (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem WHERE l_linenumber <= 4)""",
)
def standardise(t):
    train = t.lineitem.filter("l_linenumber <= 4")
    out = stats.scale(t.lineitem, ["l_quantity"], "standard", train, population=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("l_quantity", 6).alias("q"))


def _scaled_sql(base):
    return f"""SELECT p_partkey, round((p_retailprice - {base}) / w, 8) AS price FROM part,
        (SELECT min(p_retailprice) AS lo, avg(p_retailprice) AS m, max(p_retailprice) - min(p_retailprice) AS w FROM part)"""


@query("l03_min_max", _scaled_sql("lo"))
def min_max(t):
    return stats.scale(t.part, ["p_retailprice"], "minmax").select("p_partkey", F.round("p_retailprice", 8).alias("price"))


@query("l03_mean_normalise", _scaled_sql("m"))
def mean_normalise(t):
    return stats.scale(t.part, ["p_retailprice"], "mean").select("p_partkey", F.round("p_retailprice", 8).alias("price"))


@query(
    "l04_label_index",
    """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS label, p_brand AS name FROM part""",
)
def label_index(t):
    model, rows = features.index_labels(t.part, "p_brand")
    named = features.label_names(rows, "label", model.labels, "name")
    return named.select("p_partkey", "label", "name")


@query("l05_categorical_detection", "SELECT count(*) AS n, count(DISTINCT l_returnflag) AS flags FROM lineitem")
def categorical_detection(t):
    flag = F.when(F.col("l_returnflag") == "A", 10.0).when(F.col("l_returnflag") == "N", 20.0).otherwise(30.0)
    rows = features.assemble(t.lineitem.withColumn("flag", flag), ["l_extendedprice", "flag"])
    model, indexed = features.index_categories(rows, "features", "indexed")
    # only the flag column is categorical and its values became 0, 1, 2
    found = indexed.select(vector_to_array("indexed")[1].alias("code")).filter(F.col("code") < len(model.categoryMaps[1]))
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("flags"))


@query("l06_hashed_counts", f"SELECT doc_id, CAST(len({_CATALOGUE_SQL}) AS DOUBLE) AS total FROM documents")
def hashed_counts(t):
    rows = t.documents.select("doc_id", text.clean_catalogue(F.col("text"), STOP_WORDS).alias("words"))
    hashed = features.hashed_counts(rows, "words", 1000)
    return hashed.select("doc_id", features.total("tf").alias("total"))


@query("l07_hashed_tf_idf", "SELECT count(*) AS n, true AS close FROM documents")
def hashed_tf_idf(t):
    """Weights from frequencies of training documents only; against the same without hashing, term by term."""
    rows = t.documents.select("doc_id", text.clean_catalogue(F.col("text"), STOP_WORDS).alias("words"))
    rows = stored(rows, "words")
    train, _ = rel.split_by_hash(rows, "doc_id", [0.7, 0.3], seed=4)
    size = 1 << 15
    hashed = features.weigh(rows, "words", features.hashed_tf_idf(train, "words", size), size)
    sums = hashed.select("doc_id", features.total("features").alias("hashed"))
    counts = similarity.term_counts(rows, "doc_id", "words")
    df = similarity.document_frequency(similarity.term_counts(train, "doc_id", "words"))
    weight = F.col("tf") * similarity.idf(train.count(), F.coalesce("df", F.lit(0)))
    exact = counts.join(df, "term", "left").groupBy(F.col("id").alias("doc_id")).agg(F.sum(weight).alias("exact"))
    both = sums.join(exact, "doc_id", "left").withColumn("exact", F.coalesce("exact", F.lit(0.0)))
    # terms that share a bucket count as one term, so weights are lowered a little and never raised
    share = F.sum("hashed") / F.sum("exact")
    lowered = F.every(F.col("hashed") <= F.col("exact") * (1 + 1e-9) + 1e-9)
    return both.agg(F.count("hashed").alias("n"), (lowered & (share > 0.5)).alias("close"))


@query(
    "l08_stop_words",
    """SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\x0B]+'),
         lambda x: x <> '')) AS word FROM documents)
       WHERE word NOT IN (SELECT unnest(string_split(p_name, ' ')) FROM part) AND word NOT IN ('the', 'and', 'les', 'der')
       GROUP BY word""",
)
def stop_words(t):
    words = text.drop_stop_words(F.split(F.lower("text"), r"\s+"), ["the", "and", "les", "der"])
    listed = t.part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    counted = rel.word_counts(t.documents, words)
    return counted.join(listed, "word", "left_anti")


VOCABULARY = ["the", "and", "reti", "les", "der", "los", "une", "user", "that", "zzz"]


def _bag_sql(value):
    words = ", ".join(f"'{w}'" for w in VOCABULARY)
    return f"""SELECT doc_id, name, CAST({value} AS DOUBLE) AS value FROM
        (SELECT doc_id, list_filter(string_split(lower(text), ' '), lambda x: x <> '') AS w FROM documents),
        (SELECT unnest([{words}]) AS name)"""


def _bag(t, binary):
    rows = t.documents.select("doc_id", text.tokens(F.lower("text"), " ").alias("w"))
    bag = features.bag_of_words(rows, "w", VOCABULARY, binary=binary)
    return features.long_form(bag, "doc_id", "bag", sorted(VOCABULARY)).select("doc_id", "name", "value")


@query("l09_bag_of_words", _bag_sql("len(list_filter(w, lambda x: x = name))"))
def bag_of_words(t):
    return _bag(t, False)


@query("l10_multi_hot", _bag_sql("CASE WHEN list_contains(w, name) THEN 1 ELSE 0 END"))
def multi_hot(t):
    return _bag(t, True)


@query(
    "l10_one_hot",
    """SELECT vec_id, CAST(pos AS INTEGER) AS pos, CASE WHEN pos = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM embeddings,
         (SELECT unnest(range(0, (SELECT max(label) + 1 FROM embeddings))) AS pos)""",
)
def one_hot(t):
    _, rows = features.one_hot(t.embeddings.select("vec_id", "label"), "label", "hot")
    return features.long_form(rows, "vec_id", "hot")


@query(
    "l11_principal_components",
    f"""SELECT l_orderkey, l_linenumber, round({" + ".join(f"power((l_{c} - m_{c}) / s_{c}, 2)" for c in ("quantity", "extendedprice", "discount", "tax"))}, 4) AS length
        FROM lineitem, (SELECT {", ".join(f"avg(l_{c}) AS m_{c}, stddev_samp(l_{c}) AS s_{c}" for c in ("quantity", "extendedprice", "discount", "tax"))} FROM lineitem)""",
)
def principal_components(t):
    """All components together are a rotation: every row keeps the length it has in standardised columns."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    _, rows = features.pca(t.lineitem, names, len(names))
    length = F.aggregate(vector_to_array("components"), F.lit(0.0), lambda s, x: s + x * x)
    return rows.select("l_orderkey", "l_linenumber", F.round(length, 4).alias("length"))


@query("l11_component_variances", "SELECT count(*) AS n, true AS centred, true AS falling, true AS uncorrelated FROM lineitem")
def component_variances(t):
    _, rows = features.pca(t.lineitem, COLS, 3)
    v = vector_to_array("components")
    c = rows.select(*[v[i].alias(f"c{i}") for i in range(3)])
    spread_of = [F.var_samp(f"c{i}") for i in range(3)]
    return c.agg(
        F.count(F.lit(1)).alias("n"),
        (F.abs(F.avg("c0")) + F.abs(F.avg("c1")) + F.abs(F.avg("c2")) < 1e-6).alias("centred"),
        ((spread_of[0] >= spread_of[1]) & (spread_of[1] >= spread_of[2])).alias("falling"),
        (F.abs(F.corr("c0", "c1")) + F.abs(F.corr("c1", "c2")) < 1e-6).alias("uncorrelated"),
    )


@query("l13_label_recode", "SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM labels")
def label_recode(t):
    return t.labels.select("doc_id", F.when(F.col("quality") == 1, 1).otherwise(0).alias("label"))


@query(
    "l15_oversampling",
    """WITH n AS (SELECT count(*) AS rare FROM events WHERE event_type = 'purchase')
       SELECT true AS is_rare, false AS synthetic, rare AS n, true AS near_aim FROM n UNION ALL SELECT true, true, 2 * rare, true FROM n
       UNION ALL SELECT false, false, 3 * rare, true FROM n""",
)
def oversampling(t):
    rare = (F.col("event_type") == "purchase").cast("int").alias("rare")
    rows = t.v_points.join(t.events.select("event_id", rare).hint("merge"), "event_id")
    out = neighbours.oversample(rows, "event_id", ["lon", "lat"], "rare", 1, over=2, under=1.5)
    per = out.groupBy((F.col("rare") == 1).alias("is_rare"), "synthetic").agg(F.count(F.lit(1)).alias("n"))
    # the majority is thinned by a hash, so its number is near the aim, not on it
    aim = 3 * F.max(F.when(F.col("is_rare") & ~F.col("synthetic"), F.col("n"))).over(Window.partitionBy())
    near = F.col("is_rare") | (F.abs(F.col("n") / aim - 1) < 0.2)
    return per.select("is_rare", "synthetic", F.when(F.col("is_rare"), F.col("n")).otherwise(aim).alias("n"), near.alias("near_aim"))


@query("l16_missing_marker", "SELECT event_id, coalesce(CAST(flag AS DOUBLE), -2.0) AS flag FROM v_sensor")
def missing_marker(t):
    return t.v_sensor.select("event_id", features.missing_marker(F.col("flag").cast("double")).alias("flag"))


# --- evaluation ----------------------------------------------------------------------------------------

_REPORT = """WITH c AS (SELECT unnest([0, 1]) AS class),
    r AS (SELECT class, CAST(sum(CASE WHEN quality = class AND toxic = class THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                 CAST(sum(CASE WHEN toxic = class THEN 1 ELSE 0 END) AS DOUBLE) AS chosen,
                 CAST(sum(CASE WHEN quality = class THEN 1 ELSE 0 END) AS BIGINT) AS support FROM c, labels GROUP BY class),
    p AS (SELECT class, CASE WHEN chosen = 0 THEN 0 ELSE tp / chosen END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, support FROM r),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM p)"""


@query(
    "m16_classification_report",
    f"{_REPORT} SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f",
)
def classification_report(t):
    out = stats.classification_report(t.labels, "quality", "toxic")
    return out.select("class", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "m16_weighted_report",
    f"""{_REPORT} SELECT round(sum(recall * support) / sum(support), 8) AS accuracy,
          round(sum(precision * support) / sum(support), 8) AS precision, round(sum(recall * support) / sum(support), 8) AS recall,
          round(sum(f1 * support) / sum(support), 8) AS f1 FROM f""",
)
def weighted_report(t):
    out = stats.weighted_report(t.labels, "quality", "toxic")
    return out.select(*[F.round(c, 8).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


_SCORED = "(SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, round(value) AS s FROM events)"


def scored_events(t):
    return t.events.select(F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"), F.round("value").alias("s"))


@query(
    "m17_roc",
    f"""SELECT s AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
               round(sum(p) OVER w / sum(p) OVER (), 8) AS tpr, round(sum(n) OVER w / sum(n) OVER (), 8) AS fpr FROM
         (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM {_SCORED} GROUP BY s) WINDOW w AS (ORDER BY s DESC)""",
)
def roc(t):
    out = stats.roc(scored_events(t), "y", "s")
    return out.select("threshold", "tp", "fp", F.round("tpr", 8).alias("tpr"), F.round("fpr", 8).alias("fpr"))


_AUC = f"""SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS auc FROM
    (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM {_SCORED})"""


@query("m17_auc", f"SELECT round(auc, 8) AS auc FROM ({_AUC})")
def auc(t):
    return stats.auc(scored_events(t), "y", "s").select(F.round("auc", 8).alias("auc"))


@query(
    "m17_best_threshold",
    f"""SELECT threshold, round(tpr, 8) AS tpr, round(fpr, 8) AS fpr FROM
         (SELECT s AS threshold, sum(p) OVER w / sum(p) OVER () AS tpr, sum(n) OVER w / sum(n) OVER () AS fpr FROM
           (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM {_SCORED} GROUP BY s) WINDOW w AS (ORDER BY s DESC))
       ORDER BY round(tpr - fpr, 12) DESC, threshold DESC LIMIT 1""",
)
def best_threshold(t):
    out = stats.best_threshold(scored_events(t), "y", "s")
    return out.select("threshold", F.round("tpr", 8).alias("tpr"), F.round("fpr", 8).alias("fpr"))


@query(
    "m17_fixed_cut_off",
    f"""SELECT CASE WHEN s >= 12 THEN 1 ELSE 0 END AS alarm, y, count(*) AS n FROM {_SCORED} GROUP BY 1, 2""",
)
def fixed_cut_off(t):
    alarm = right_closed(-F.col("s"), [-12.0], [1, 0])
    return scored_events(t).groupBy(alarm.alias("alarm"), "y").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m18_fit_on_pairs",
    f"""SELECT round(1 - sum(pow(rating - pred, 2)) / (var_pop(rating) * count(*)), 6) AS r2 FROM ({_ITEM_MEAN})""",
)
def fit_on_pairs(t):
    return stats.r2(with_item_mean(t), "rating", "pred").withColumn("r2", F.round("r2", 6))


@query(
    "m26_align_clusters",
    """SELECT p_size, label, n FROM (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY n DESC, label) AS r FROM
         (SELECT p_size, p_partkey % 7 AS label, count(*) AS n FROM part GROUP BY 1, 2)) WHERE r = 1""",
)
def align_clusters(t):
    rows = t.part.select("p_size", (F.col("p_partkey") % 7).alias("label"))
    return stats.align_clusters(rows, "p_size", "label")
