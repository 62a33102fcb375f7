from datetime import datetime

from pyspark.sql import functions as F

from sparkdeck.functions import records, scalar, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("o")).first().o


def test_tokens_drop_empty_pieces(spark):
    assert one(spark, "  a  b ", lambda c: text.tokens(c, " ")) == ["a", "b"]
    assert one(spark, "...", lambda c: text.tokens(text.strip_punctuation(c), " ")) == []
    assert one(spark, "", text.tokens) == []


def test_clean_product(spark):
    assert one(spark, "<p>Éclair: l'été</p> <br>100%, (a-b)\n", text.clean_product) == "eclair  l ete100% ab"


def test_clean_social(spark):
    got = one(spark, "Où -- Çà coûte 25$ : l'été, (là) Zoë- dit \"ñandú\" re- et -ré²!", text.clean_social)
    assert got == "ou ca coute l ete la zoe dit nandu re et re".split()


def test_clean_catalogue(spark):
    got = one(spark, "Le Café_noir, 2x the box of tea", lambda c: text.clean_catalogue(c, ["the"]))
    assert got == ["caf", "_noir", "box", "tea"]


def test_bands_and_classes(spark):
    bands = [one(spark, v, lambda c: scalar.score_band(c, [0.8, 0.6], ["hi", "mid", "lo"]), "double") for v in (0.8, 0.6, 0.59, None)]
    assert bands == ["hi", "mid", "lo", None]
    classes = [one(spark, v, lambda c: scalar.right_closed(c, [0.0, 0.1]), "double") for v in (-1.0, 0.0, 0.05, 0.1, 0.2, float("nan"), None)]
    assert classes == [0, 0, 1, 1, 2, None, None]
    colors = [one(spark, v, lambda c: scalar.color_ramp(c, "0:a;0.1:b;1:c"), "double") for v in (-1.0, 0.0, 0.1, 0.99, 1.0, None)]
    assert colors == ["a", "a", "b", "b", "c", None]


def test_small_scalars(spark):
    assert one(spark, "1,25", scalar.decimal_comma) == 1.25
    assert one(spark, "x", scalar.decimal_comma) is None
    assert str(one(spark, "T30_20240229_x", scalar.name_date)) == "2024-02-29"
    assert one(spark, "none", scalar.name_date) is None
    assert one(spark, "2000-01-01", lambda c: scalar.age_years(c.cast("date"), F.lit("2001-12-30").cast("date"))) == 1
    assert one(spark, 800.0, scalar.logistic, "double") == 1.0
    assert one(spark, -800.0, scalar.logistic, "double") == 0.0
    assert one(spark, 9588.0, lambda c: scalar.clamp_rescale(c, 4000, 15176), "double") == 127.5


def test_access_log(spark):
    line = '1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /a?b=1 HTTP/1.0" 200 - "http://x/" "Mozilla (x)"'
    f = one(spark, line, records.parse_access_log)
    assert (f.clientip, f.auth, f.verb, f.request, f.response, f.bytes, f.agent) == ("1.2.3.4", "bob", "GET", "/a?b=1", 200, None, "Mozilla (x)")
    assert f.timestamp == datetime(2000, 10, 10, 20, 55, 36)
    assert one(spark, "not a log line", records.parse_access_log) is None
    odd = one(spark, '1.2.3.4 - - [10/Oct/2000:13:55:36 +0000] "-" 408 0 "-" "-"', records.parse_access_log)
    assert (odd.verb, odd.response, odd.bytes) == ("", 408, 0)


def test_error_log(spark):
    f = one(spark, "[Sun Mar 03 21:05:09.000407 2024] [ssl:warn] [pid 77] AH01906: bad name: 'x'", records.parse_error_log)
    assert (f.module, f.level, f.pid, f.code, f.message) == ("ssl", "warn", 77, "AH01906", "bad name: 'x'")
    assert f.timestamp == datetime(2024, 3, 3, 21, 5, 9, 407)
    bare = one(spark, "AH00001: server: no name", records.parse_error_log)
    assert (bare.code, bare.message) == (None, "AH00001: server: no name")


def test_event_routing(spark):
    rows = [
        (1, '{"idsite":"1","idgoal":"5"}'),
        (2, '{"idgoal":"0","ec_items":"[[\\"p1\\",1]]"}'),
        (3, '{"idgoal":"0","ec_id":"e","ec_items":"[[\\"p2\\",1],[\\"p3\\",2]]"}'),
        (4, "{broken"),
        (5, None),
    ]
    out = records.route_events(spark.createDataFrame(rows, "i int, value string")).orderBy("i").collect()
    assert [r.kind for r in out] == ["page", "cart", "purchase", "page", "page"]
    assert out[2]["items"] == [["p2", "1"], ["p3", "2"]]
    assert (out[3].idsite, out[3].idgoal, out[3].visitor) == ("0", "-1", "none")
