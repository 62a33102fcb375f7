import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sparkdeck.session import fresh_path, stored, workspace
from sparkdeck.sources import connectors, files
from sparkdeck.streaming import operators as ops, sinks
from sparkdeck.streaming.sources import stream_files
from sparkdeck.streaming.versions import Versions


def test_rows_with_names_and_schema(spark):
    named = files.from_rows(spark, [(1, "a"), (2, "b")], ["number", "word"])
    assert named.columns == ["number", "word"] and named.count() == 2
    schema = StructType([StructField("number", IntegerType(), True), StructField("word", StringType(), True)])
    df = files.from_rows(spark, [(8, "bat"), (None, None)], schema)
    assert df.filter("number != 8").count() == 0 and df.schema == schema


def test_multi_line_json(spark, tmp_path):
    doc = [{"City": "A", "Day": 1, "t": 2.5}, {"City": "B", "Day": 2, "t": None}]
    (tmp_path / "one.json").write_text(json.dumps(doc, indent=2))
    out = files.read_json(spark, str(tmp_path), "City string, Day bigint, t double", multi_line=True)
    assert sorted((r.City, r.Day, r.t) for r in out.collect()) == [("A", 1, 2.5), ("B", 2, None)]


def test_space_and_inferred_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("name cal\nx 10\ny 20\n")
    out = files.read_delimited(spark, str(tmp_path), sep=" ", infer=True)
    assert out.schema["cal"].dataType.typeName() == "integer" and out.count() == 2


def test_bad_numbers_become_null(spark):
    raw = spark.createDataFrame([("1", "x")], "a string, b string")
    row = files.cast_columns(raw, ["n", "m"], ["int", "double"]).first()
    assert (row.n, row.m) == (1, None)


def test_upsert_inserts_and_replaces(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "id int, v int, s string")
    new = spark.createDataFrame([(2, 4, "late"), (1, 2, "c"), (3, 1, "d")], "id int, v int, s string")
    out = files.upsert(old, new, ["id"], "v")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "c"), (2, 5, "b"), (3, 1, "d")]


def test_database_reader_options(spark):
    with pytest.raises(Exception):
        connectors.read_database(spark, "jdbc:none:x", query="select 1")


def test_listing_does_not_read_contents(spark, tmp_path):
    folder = tmp_path / "S2_X.SAFE" / "T30"
    folder.mkdir(parents=True)
    (folder / "T30_B04.jp2").write_bytes(b"1")
    (folder / "T30_B04.jp2.xml").write_bytes(b"1")
    out = files.scene_catalog(files.list_files(spark, str(tmp_path)))
    assert [(r.scene, r.band) for r in out.collect()] == [("T30", "B04")]


def test_stored_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or workspace(spark) == configured
    assert workspace(spark).rsplit(":", 1)[-1] in stored(spark.range(5)).inputFiles()[0]


def write(spark, folder, rows):
    spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.mode("append").parquet(folder)


START = datetime(2024, 1, 1)


def test_late_rows_beyond_the_watermark_are_dropped(spark):
    src, out, cp = (fresh_path(spark, n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "ts timestamp, k string").schema

    def run():
        stream = stream_files(spark, src, schema, files_per_batch=1)
        sinks.append_table(ops.windowed_count(stream, "ts", "10 minutes", keys=["k"], watermark="10 minutes"), out, cp)

    write(spark, src, [(START + timedelta(minutes=m), "a") for m in (1, 2, 12)])
    run()
    write(spark, src, [(START + timedelta(minutes=90), "a")])
    run()
    write(spark, src, [(START + timedelta(minutes=3), "late"), (START + timedelta(minutes=300), "a")])
    run()
    got = sorted((r.start, r.k, r.n) for r in spark.read.parquet(out).collect())
    assert got == [(START, "a", 2), (START + timedelta(minutes=10), "a", 1), (START + timedelta(minutes=90), "a", 1)]


def test_restart_continues_counts(spark):
    src, out, cp = (fresh_path(spark, n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "ts timestamp, k string").schema
    for part in range(3):
        write(spark, src, [(START + timedelta(seconds=part), "a"), (START + timedelta(seconds=part), "b")])
        sinks.update_table(ops.windowed_count(stream_files(spark, src, schema), "ts", "1 minute", keys=["k"]), out, cp, ["start", "end", "k"], compact_every=2)
    # the third batch makes one folder of all; the version before it is still there
    table = Versions(spark, out)
    assert table.numbers() == [1, 2] and [len(table.folders(n)) for n in (1, 2)] == [2, 1]
    counts = sinks.current(spark, out, ["start", "end", "k"])
    assert sorted((r.k, r.n) for r in counts.collect()) == [("a", 3), ("b", 3)]


def test_upsert_table_over_several_batches(spark):
    src, out, cp = (fresh_path(spark, n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "id int, v int").schema
    for rows in ([(1, 1), (2, 1)], [(1, 3), (3, 1)], [(1, 2)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        sinks.upsert_table(stream_files(spark, src, schema), out, cp, ["id"], "v")
    want = [(1, 3), (2, 1), (3, 1)]
    assert sorted(tuple(r) for r in sinks.merged(spark, out, ["id"], "v").collect()) == want


def test_versions_hold_for_readers_and_replays(spark):
    """A reader opened before a compaction sees its version; a replayed batch changes nothing; old folders go."""
    src, out, cp = (fresh_path(spark, n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "id int, v int").schema
    held, states = {}, {}
    for k in range(6):
        spark.createDataFrame([(k % 3, k), (10 + k, k)], schema).coalesce(1).write.mode("append").parquet(src)
        sinks.upsert_table(stream_files(spark, src, schema), out, cp, ["id"], "v", compact_every=2)
        states[k] = {i: max(j for j in range(k + 1) if j % 3 == i) for i in range(min(3, k + 1))} | {10 + j: j for j in range(k + 1)}
        if k:  # opened at the version before, read after the log has moved on
            assert {r.id: r.v for r in held[k - 1].collect()} == states[k - 1]
        held[k] = sinks.merged(spark, out, ["id"], "v")
        assert {r.id: r.v for r in held[k].collect()} == states[k]
    table = Versions(spark, out)
    assert table.numbers() == [4, 5] and {r.id: r.v for r in sinks.merged(spark, out, ["id"], "v", 4).collect()} == states[4]
    named = {f for n in (4, 5) for f, _ in table.folders(n)}
    there = {f"{out}/data/{s.getPath().getName()}" for s in table.fs.globStatus(table._at("data/*"))}
    assert there == named and max(len(table.folders(n)) for n in (4, 5)) <= 2
    # the last batch once more, as after a crash between its writes and its commit
    batch = spark.createDataFrame([(2, 5), (15, 5)], schema)
    shorten = lambda folders: sinks.newest(spark.read.parquet(*[f for f, _ in folders]), ["id"], "v")
    table.write(batch, "batch", 5)  # a folder that no version names
    sinks._logged(table, batch, 5, shorten, 2, 2)
    assert {r.id: r.v for r in sinks.merged(spark, out, ["id"], "v").collect()} == states[5]
    there = {f"{out}/data/{s.getPath().getName()}" for s in table.fs.globStatus(table._at("data/*"))}
    assert there == {f for n in table.numbers() for f, _ in table.folders(n)}


def test_site_filter_is_not_a_prefix_match(spark):
    df = spark.createDataFrame([('{"idsite":"1"}',), ('{"idsite":"10"}',), ("bad",)], "value string")
    assert ops.of_site(df, "value", "1").count() == 1
    assert df.filter(F.col("value").contains('"idsite":"1')).count() == 2
