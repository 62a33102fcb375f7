"""Scalar functions, text cleaning, logs, similarity and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records, scalar, text
from ..functions.stems import stem_tokens
from ..operators import features, ordered, search as find, similarity
from ..operators.raster import COLOR_RAMP
from ..session import fresh_path, stored
from .registry import query

#: words that have an index of their own; all others decode to the default
VOCABULARY_SIZE = 300
STOP_WORDS = ["the", "and", "les", "des", "une", "der", "die", "das", "los", "las"]

_PUNCT = r"[!-/:-@\[-`{-~]"


@query(
    "h01_strip_punctuation",
    f"SELECT doc_id, md5(regexp_replace(text, '{_PUNCT}', '', 'g')) AS clean FROM documents",
)
def strip_punctuation(t):
    return t.documents.select("doc_id", F.md5(text.strip_punctuation(F.col("text"))).alias("clean"))


@query(
    "h02_lower_split",
    "SELECT doc_id, len(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS n FROM documents",
)
def lower_split(t):
    return t.documents.select("doc_id", F.size(text.tokens(F.lower("text"), " ")).cast("bigint").alias("n"))


_PRODUCT_SQL = r"""strip_accents(translate(lower(regexp_replace(html, '(?s)<[^>]*>(\s*<[^>]*>)*', '', 'g')),
    ':''.;,!/§?*-&~#(|`_\^@)][=}{"+<>' || chr(10), '  '))"""


@query("h03_clean_product_text", f"SELECT page_id, md5({_PRODUCT_SQL}) AS clean FROM pages")
def clean_product_text(t):
    return t.pages.select("page_id", F.md5(text.clean_product(F.col("html"))).alias("clean"))


_SOCIAL_SQL = r"""list_filter(regexp_split_to_array(lower(replace(replace(replace(replace(
    translate(translate(translate(text, 'ªº§³²¹', 'AOS   '),
      'ÀÁÂÃÄÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜàáâãäçèéêëìíîïñòóôõöùúûü', 'AAAAACEEEEIIIINOOOOOUUUUaaaaaceeeeiiiinooooouuuu'),
      '!.?,;:/+%()[]&`*$«»''_|"0123456789' || chr(9), repeat(' ', 40)),
    ' -', ' '), '- ', ' '), '--', ' '), ' - ', ' ')), '[ \t\n\r\f\x0B]+'), lambda x: x <> '')"""


@query(
    "h04_clean_social_text",
    f"SELECT conv_id, turn, array_to_string({_SOCIAL_SQL}, ' ') AS clean FROM conversations",
)
def clean_social_text(t):
    return t.conversations.select("conv_id", "turn", F.array_join(text.clean_social(F.col("text")), " ").alias("clean"))


_CATALOGUE_SQL = f"""list_filter(string_split(regexp_replace(lower(text), '[^a-z_]', ' ', 'g'), ' '),
    lambda x: length(x) > 2 AND x NOT IN ({', '.join(repr(w) for w in STOP_WORDS)}))"""


@query(
    "h05_clean_catalogue_text",
    f"SELECT doc_id, md5(array_to_string({_CATALOGUE_SQL}, ' ')) AS clean FROM documents",
)
def clean_catalogue_text(t):
    clean = text.clean_catalogue(F.col("text"), STOP_WORDS)
    return t.documents.select("doc_id", F.md5(F.array_join(clean, " ")).alias("clean"))


@query("h06_concat_columns", "SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS label FROM part")
def concat_columns(t):
    return t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("label"))


@query(
    "h07_json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


_BROKEN = "CASE WHEN event_id % 9 = 0 THEN concat('{', value) ELSE value END"


@query(
    "h08_json_record",
    f"""SELECT event_id, CASE WHEN json_valid(v) THEN json_extract_string(v, '$.idsite') END AS site,
               CASE WHEN json_valid(v) THEN len(json_keys(v)) ELSE 0 END AS fields
        FROM (SELECT event_id, {_BROKEN} AS v FROM v_json)""",
)
def json_record(t):
    empty = F.expr("CAST(map() AS map<string,string>)")
    record = F.coalesce(F.from_json("v", "map<string,string>"), empty)
    rows = t.v_json.withColumn("v", F.expr(_BROKEN)).select("event_id", record.alias("m"))
    return rows.select("event_id", F.try_element_at("m", F.lit("idsite")).alias("site"), F.size("m").alias("fields"))


_ROUTE_SQL = """SELECT event_id,
    CASE WHEN j ->> 'idgoal' <> '0' THEN 'page' WHEN j ->> 'ec_id' IS NULL THEN 'cart' ELSE 'purchase' END AS kind,
    j ->> 'idsite' AS idsite, j ->> '_id' AS visitor, coalesce(j ->> 'uid', '0') AS uid,
    CASE WHEN j ->> 'ec_items' IS NOT NULL THEN json_extract_string(j ->> 'ec_items', '$[0][0]') END AS item
    FROM (SELECT event_id, CAST(value AS JSON) AS j FROM v_json)"""


@query("h09_nested_json_items", _ROUTE_SQL)
def nested_json_items(t):
    routed = records.route_events(t.v_json)
    return routed.select("event_id", "kind", "idsite", "visitor", "uid", F.col("items")[0][0].alias("item"))


@query(
    "h10_replace_then_cast",
    "SELECT doc_id, CASE WHEN toxic = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS ok FROM labels",
)
def replace_then_cast(t):
    return t.labels.select("doc_id", F.when(F.col("toxic") == 1, "0").otherwise("1").cast("double").alias("ok"))


@query(
    "h11_date_text_to_quarter",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders",
)
def date_text_to_quarter(t):
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("d"))
    day = F.to_date("d", "dd/MM/yyyy")
    return written.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), F.quarter(day).alias("quarter"))


@query("h12_parse_timestamp", "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS secs FROM events")
def parse_timestamp(t):
    written = t.events.select("event_id", F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("s"))
    return written.select("event_id", F.unix_timestamp(F.to_timestamp("s", "yyyy/MM/dd HH:mm:ss")).alias("secs"))


@query(
    "h13_age_in_years",
    "SELECT o_orderkey, CAST(trunc(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-06-30') / 365) AS BIGINT) AS age FROM orders",
)
def age_in_years(t):
    return t.orders.select("o_orderkey", scalar.age_years(F.to_date("o_orderdate"), F.lit("2024-06-30").cast("date")).alias("age"))


@query(
    "h14_six_months_back",
    """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS secs FROM orders
       WHERE epoch(o_orderdate) > epoch(DATE '1998-09-30' - INTERVAL 6 MONTH)""",
)
def six_months_back(t):
    secs = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    bound = F.unix_timestamp(F.add_months(F.lit("1998-09-30").cast("date"), -6).cast("timestamp"))
    return t.orders.select("o_orderkey", secs.alias("secs")).filter(F.col("secs") > bound)


_NAMED = "SELECT o_orderkey, concat('S2_T30_', {fmt}, '_stats.shp') AS name FROM orders"


@query(
    "h15_date_in_name",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y%m%d') AS token FROM orders",
)
def date_in_name(t):
    name = F.concat(F.lit("S2_T30_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_stats.shp"))
    named = t.orders.select("o_orderkey", name.alias("name"))
    token = F.split("name", "_")[2]
    return named.select("o_orderkey", F.date_format(scalar.name_date(F.col("name")), "yyyy-MM-dd").alias("day"), token.alias("token"))


@query("h16_round_half_up", "SELECT event_id, round(value / 8, 5) AS r FROM events")
def round_half_up(t):
    return t.events.select("event_id", F.round(F.col("value") / 8, 5).alias("r"))


@query("h17_floor_bins", "SELECT event_id, CAST(floor(value / 2.5) AS BIGINT) AS bin FROM events")
def floor_bins(t):
    return t.events.select("event_id", F.floor(F.col("value") / 2.5).alias("bin"))


@query(
    "h18_math",
    """SELECT event_id, round(sqrt(value), 6) AS root, round(pow(value - 10, 2), 6) AS square, round(abs(value - 10), 6) AS dist,
              round(exp(value / 50) / (1 + exp(value / 50)), 8) AS logistic FROM events""",
)
def math(t):
    v = F.col("value")
    return t.events.select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.pow(v - 10, 2), 6).alias("square"),
        F.round(F.abs(v - 10), 6).alias("dist"), F.round(scalar.logistic(v / 50), 8).alias("logistic"),
    )


@query(
    "h19_nan_sentinel",
    "SELECT x, y, coalesce(CASE WHEN red + nir <> 0 THEN nir / (red + nir) END, -2147483648.0) AS v FROM v_pixels",
)
def nan_sentinel(t):
    total = F.col("red") + F.col("nir")
    share = F.when(total != 0, F.col("nir") / total).otherwise(F.lit(float("nan")))
    filled = F.coalesce(scalar.nan_to_null(share), F.lit(-2147483648.0))
    return t.v_pixels.select("x", "y", filled.alias("v"))


@query(
    "h20_clamp_and_rescale",
    """SELECT x, y, CASE WHEN nir = 0 THEN nir ELSE round((least(greatest(nir, 4000), 15176) - 4000) / 11176.0 * 255, 6) END AS v
       FROM v_pixels""",
)
def clamp_and_rescale(t):
    v = scalar.clamp_rescale(F.col("nir"), 4000, 15176)
    return t.v_pixels.select("x", "y", F.when(F.col("nir") == 0, F.col("nir")).otherwise(F.round(v, 6)).alias("v"))


@query(
    "h22_arrays",
    """SELECT doc_id, len(list_distinct(w)) AS n_distinct, list_contains(w, 'the') AS has, w[1] AS first
       FROM (SELECT doc_id, list_filter(string_split(lower(text), ' '), lambda x: x <> '') AS w FROM documents)""",
)
def arrays(t):
    words = t.documents.select("doc_id", text.tokens(F.lower("text"), " ").alias("w"))
    return words.select(
        "doc_id", F.size(F.array_distinct("w")).alias("n_distinct"), F.array_contains("w", "the").alias("has"),
        F.get("w", F.lit(0)).alias("first"),
    )


@query("h23_zip_arrays", "SELECT x, y, red + nir AS total, greatest(red, nir) AS top FROM v_pixels")
def zip_arrays(t):
    zipped = F.transform(F.arrays_zip(F.array("red").alias("a"), F.array("nir").alias("b")), lambda z: F.array(z["a"], z["b"]))
    rows = t.v_pixels.select("x", "y", zipped[0].alias("v"))
    return rows.select("x", "y", (F.col("v")[0] + F.col("v")[1]).alias("total"), F.array_max("v").alias("top"))


@query(
    "h24_explode",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word",
)
def explode(t):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "h25_explode_structs",
    """SELECT c_custkey, 'balance' AS field, CAST(c_acctbal AS VARCHAR) AS value, NULL::INTEGER AS code FROM customer
       UNION ALL SELECT c_custkey, 'nation', NULL, c_nationkey FROM customer""",
)
def explode_structs(t):
    nested = t.customer.select(
        "c_custkey",
        F.array(
            F.struct(F.lit("balance").alias("field"), F.col("c_acctbal").cast("string").alias("value"), F.lit(None).cast("int").alias("code")),
            F.struct(F.lit("nation").alias("field"), F.lit(None).cast("string").alias("value"), F.col("c_nationkey").alias("code")),
        ).alias("entries"),
    )
    return nested.select("c_custkey", F.inline("entries"))


@query(
    "h26_geojson_point",
    """SELECT event_id, '{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}' AS g FROM v_points""",
)
def geojson_point(t):
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    return t.v_points.select("event_id", point.alias("g"))


def log_lines(fields):
    """Access log lines formatted from their fields; works on tables and on streams."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss Z")
    return fields.select(
        "event_id",
        F.format_string(
            '%s - - [%s] "GET %s HTTP/1.1" %d %d "-" "agent %d"',
            "clientip", stamp, "request", "response", "bytes", "event_id",
        ).alias("line"),
    )


@query(
    "h27_access_log",
    """SELECT event_id, clientip, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS secs, 'GET' AS verb, request,
              response, bytes, 'agent ' || event_id AS agent FROM v_log_fields""",
)
def access_log(t):
    parsed = log_lines(t.v_log_fields).select("event_id", records.parse_access_log(F.col("line")).alias("f"))
    return parsed.select(
        "event_id", "f.clientip", F.unix_timestamp("f.timestamp").alias("secs"), "f.verb", "f.request", "f.response",
        "f.bytes", "f.agent",
    )


_ERROR_LINES = """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN CONCAT('AH', CAST(event_id AS STRING), ': no brackets')
    ELSE CONCAT('[Sun Mar 03 21:05:09.000407 2024] [', event_type, ':notice] [pid ', CAST(user_id AS STRING), '] AH',
                CAST(event_id AS STRING), ': caught [', event_type, '] down') END AS line FROM events"""


@query(
    "h28_error_log",
    """SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN event_type END AS module,
              CASE WHEN event_id % 6 <> 0 THEN 'notice' END AS level,
              CASE WHEN event_id % 6 <> 0 THEN CAST(user_id AS INTEGER) END AS pid,
              CASE WHEN event_id % 6 <> 0 THEN 'AH' || event_id END AS code,
              CASE WHEN event_id % 6 <> 0 THEN 'caught [' || event_type || '] down' ELSE 'AH' || event_id || ': no brackets' END
                AS message,
              CASE WHEN event_id % 6 <> 0 THEN 1709499909000407 END AS micros FROM events""",
)
def error_log(t):
    parsed = t.sql(_ERROR_LINES).select("event_id", records.parse_error_log(F.col("line")).alias("f"))
    return parsed.select(
        "event_id", "f.module", "f.level", "f.pid", "f.code", "f.message", F.unix_micros("f.timestamp").alias("micros")
    )


@query(
    "h29_move_into_struct",
    "SELECT event_id, 'add' AS action, json_object('log', event_type) AS message FROM events",
)
def move_into_struct(t):
    shaped = t.events.select("event_id", F.lit("add").alias("action"), F.struct(F.col("event_type").alias("log")).alias("message"))
    return shaped.withColumn("message", F.to_json("message"))


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '')"


@query(
    "h30_decode_indexes",
    f"""WITH w AS (SELECT conv_id * 1000 + turn AS id, unnest({_WORDS}) AS word, generate_subscripts({_WORDS}, 1) AS pos
                   FROM conversations),
         top AS (SELECT word FROM (SELECT word, count(*) AS n FROM w GROUP BY 1) ORDER BY n DESC, word LIMIT {VOCABULARY_SIZE})
       SELECT id, md5(string_agg(coalesce(top.word, '?'), ' ' ORDER BY pos)) AS text
       FROM w LEFT JOIN top ON top.word = w.word GROUP BY id""",
)
def decode_indexes(t):
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    docs = t.conversations.select(key, text.tokens(F.lower("text")).alias("words"))
    counts = docs.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), "word").limit(VOCABULARY_SIZE).withColumn("_neg", -F.col("n"))
    dictionary = ordered.row_index(top, [], ["_neg", "word"]).select("word", "idx")
    coded = features.encode_tokens(docs, "id", "words", dictionary)
    return features.decode_tokens(coded, "id", "ids", dictionary).withColumn("text", F.md5("text"))


@query(
    "h31_minute_in_zone",
    """SELECT strftime(date_trunc('minute', ts + INTERVAL 1 HOUR), '%Y-%m-%d %H:%M') AS minute, event_type, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def minute_in_zone(t):
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Europe/Berlin")
    minute = F.date_format(F.date_trunc("minute", local), "yyyy-MM-dd HH:mm")
    return t.events.groupBy(minute.alias("minute"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "h32_color_ramp",
    """SELECT x, y, CASE WHEN v IS NULL THEN NULL WHEN v >= 1 THEN '004529ff' WHEN v >= 0.7 THEN '006837ff'
         WHEN v >= 0.6 THEN '238443ff' WHEN v >= 0.5 THEN '41ab5dff' WHEN v >= 0.4 THEN '78c679ff'
         WHEN v >= 0.3 THEN 'addd8eff' WHEN v >= 0.2 THEN 'd9f0a3ff' WHEN v >= 0.1 THEN 'f7fcb9ff' ELSE 'ffffe5ff' END AS color
       FROM (SELECT x, y, CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END AS v FROM v_pixels)""",
)
def color_ramp(t):
    total = F.col("nir") + F.col("red")
    v = F.when(total != 0, (F.col("nir") - F.col("red")) / total)
    return t.v_pixels.select("x", "y", scalar.color_ramp(v, COLOR_RAMP).alias("color"))


@query("j02_stem_counts")
def stem_counts(t):
    french = t.documents.filter("lang = 'fr'")
    words = french.select("doc_id", F.explode(text.clean_catalogue(F.col("text"), STOP_WORDS)).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stem_tokens(counted).groupBy("stem").agg(F.sum("n").alias("n"))


# --- similarity and search -------------------------------------------------------------------------

def documents_with_tokens(t):
    return t.documents.select("doc_id", text.clean_catalogue(F.col("text"), STOP_WORDS).alias("words"))


_TERMS = f"""tok AS (SELECT doc_id AS id, {_CATALOGUE_SQL} AS words FROM documents),
    tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(words) AS term FROM tok) GROUP BY 1, 2),
    dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    w AS (SELECT id, term, tf, df, tf * ln((m + 1) / (df + 1)) AS w FROM tf JOIN dfs USING (term),
          (SELECT CAST(count(*) AS DOUBLE) AS m FROM documents))"""


@query("l07_tf_idf", f"WITH {_TERMS} SELECT id, term, tf, df, round(w, 6) AS w FROM w")
def tf_idf(t):
    out = similarity.tf_idf(documents_with_tokens(t), "doc_id", "words")
    return out.withColumn("w", F.round("w", 6))


_PAIRS = f"""{_TERMS},
    keyed AS (SELECT id, md5(array_to_string(list_sort(words), ' ')) AS k FROM tok),
    reps AS (SELECT k, min(id) AS rep FROM keyed GROUP BY k),
    groups AS (SELECT id, rep FROM keyed JOIN reps USING (k)),
    u AS (SELECT id, term, w / n AS u FROM w JOIN (SELECT id, sqrt(sum(w * w)) AS n FROM w GROUP BY id) USING (id) WHERE n > 0
          AND id IN (SELECT rep FROM reps)),
    pairs AS (SELECT a.id AS a, b.id AS b, sum(a.u * b.u) AS sim FROM u a JOIN u b ON a.term = b.term AND a.id < b.id
              GROUP BY 1, 2)"""


@query("n07_cosine_pairs", f"WITH {_PAIRS} SELECT a, b, round(sim, 6) AS sim FROM pairs WHERE sim >= 0.4")
def cosine_pairs(t):
    _, pairs = similarity.similar_documents(documents_with_tokens(t), "doc_id", "words", 0.4)
    # written, so that every two blocks are compared once, however often the pairs are read
    return stored(pairs.withColumn("sim", F.round("sim", 6)), "pairs", compression="zstd")


@query(
    "n08_most_similar",
    f"""WITH {_PAIRS},
      both_ways AS (SELECT a, b, round(sim, 9) AS sim FROM pairs UNION ALL SELECT b, a, round(sim, 9) FROM pairs
                    UNION ALL SELECT rep, rep, 1.0 FROM reps),
      near AS (SELECT g.id, o.id AS other, sim FROM groups g JOIN both_ways ON a = g.rep JOIN groups o ON o.rep = b
               WHERE o.id <> g.id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS rank FROM near)
    SELECT r.id, other, a.source AS source, b.source AS other_source, round(sim, 6) AS sim, rank,
           least(n, 5) AS found FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM ranked) r
    JOIN documents a ON a.doc_id = r.id JOIN documents b ON b.doc_id = other WHERE rank <= 5""",
)
def most_similar(t):
    top = similarity.nearest_documents(documents_with_tokens(t), "doc_id", "words", 5)
    names = t.documents.select("doc_id", "source")
    named = top.join(names.select(F.col("doc_id").alias("id"), "source"), "id").join(
        names.select(F.col("doc_id").alias("other"), F.col("source").alias("other_source")), "other"
    )
    return named.withColumn("sim", F.round("sim", 6))


_SEARCH_FIELDS = ["text", "role"]
_SEARCH_QUERY = "reti user"


def _word_sql(c):
    return f"list_filter(string_split(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"


def _search_sql():
    parts = []
    for f in _SEARCH_FIELDS:
        for term in _SEARCH_QUERY.split():
            parts.append(
                f"""SELECT id, CASE WHEN tf > 0 THEN ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                       / (tf + 1.2 * (0.25 + 0.75 * len / avg_len)) ELSE 0 END AS s
                    FROM (SELECT *, count(*) OVER () AS n, sum(CASE WHEN tf > 0 THEN 1 ELSE 0 END) OVER () AS df,
                                 avg(len) OVER () AS avg_len
                          FROM (SELECT id, len({f}) AS len, len(list_filter({f}, lambda x: x = '{term}')) AS tf FROM w))"""
            )
    return f"""WITH w AS (SELECT conv_id * 1000 + turn AS id, {_word_sql('text')} AS text, {_word_sql('role')} AS role
                        FROM conversations)
        SELECT id, round(sum(s), 6) AS score FROM ({' UNION ALL '.join(parts)}) GROUP BY id HAVING sum(s) > 0
        ORDER BY round(sum(s), 9) DESC, id LIMIT 20"""


def _talk(t):
    return t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", "role")


def _index(t):
    path = fresh_path(t.spark, "index")
    find.build_index(_talk(t), "id", _SEARCH_FIELDS, path)
    return path


@query("n09_text_search", _search_sql())
def text_search(t):
    return find.search(t.spark, _index(t), _SEARCH_QUERY, 20).withColumn("score", F.round("score", 6))


@query(
    "n10_match_any_clause",
    f"""SELECT conv_id * 1000 + turn AS id FROM conversations
        WHERE list_has_any({_word_sql('text')}, ['reti', 'the']) OR list_has_any({_word_sql('role')}, ['reti', 'the'])""",
)
def match_any_clause(t):
    return find.matching(t.spark, _index(t), "reti the")
