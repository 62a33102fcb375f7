import math
import random
import statistics

from pyspark.sql import functions as F

from sparkdeck.operators import raster, series, spatial
from sparkdeck.session import fresh_path


def grid(spark, rows):
    return spark.createDataFrame(rows, "x int, y int, v double")


def test_normalized_difference_without_data(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 1.0), (None, 1.0), (1.0, -1.0)], "a double, b double")
    assert [r.n for r in raster.normalized_difference(df, "a", "b", "n").collect()] == [None, 0.5, None, None]


def test_tile_rule_for_one_and_two_gaps(spark):
    rows = [(t, 0, i, 0, 1.0 + i if i >= gaps else None) for t, gaps in enumerate((0, 1, 2)) for i in range(4)]
    df = spark.createDataFrame(rows, "tile_col int, tile_row int, x int, y int, v double")
    any_gap = {r.tile_col: r for r in raster.tile_stats(df, "v", 1).collect()}
    two = {r.tile_col: r for r in raster.tile_stats(df, "v", 2).collect()}
    assert (any_gap[0]["min"], any_gap[0]["max"], any_gap[0]["mean"]) == (1.0, 4.0, 2.5)
    assert any_gap[1]["mean"] == any_gap[2]["mean"] == raster.NODATA and any_gap[1]["std"] == 0.0
    assert two[1]["mean"] is None and two[2]["mean"] == raster.NODATA


def test_missing_band_is_null(spark):
    df = spark.createDataFrame([("s", 0, 0, "B2", 1.0), ("s", 0, 0, "B9", 5.0)], "scene string, x int, y int, band string, value double")
    row = raster.assemble_bands(df, ["B2", "B3"]).first()
    assert (row.B2, row.B3) == (1.0, None)


def test_mosaic_prefers_priority_with_data(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 1), (0, 0, None, 2), (1, 0, 3.0, 1), (1, 0, 4.0, 2)], "x int, y int, v double, p int")
    assert sorted((r.x, r.v) for r in raster.mosaic(df, "v", "p").collect()) == [(0, 1.0), (1, 4.0)]


def test_negative_later_values(spark):
    out = raster.raster_diff(grid(spark, [(0, 0, -0.2), (1, 0, 0.5), (2, 0, 0.1)]), grid(spark, [(0, 0, 0.1), (1, 0, 0.2)]), "v")
    assert sorted((r.x, round(r["diff"], 6)) for r in out.collect()) == [(0, -99.1), (1, 0.3)]


def test_median_filter_equals_loop(spark):
    rng = random.Random(2)
    cells = {(x, y): (None if rng.random() < 0.15 else float(rng.randint(0, 5))) for x in range(7) for y in range(6)}
    out = raster.median_filter(grid(spark, [(x, y, v) for (x, y), v in cells.items()]), "v", out="m")
    for r in out.collect():
        if cells[r.x, r.y] is None:
            assert r.m is None
            continue
        near = [cells[min(max(r.x + i, 0), 6), min(max(r.y + j, 0), 5)] for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert r.m == statistics.median([v for v in near if v is not None])


def test_class_edges(spark):
    df = grid(spark, [(i, 0, v) for i, v in enumerate([-1.0, 0.0, 0.1, 0.1000001, 0.7, 0.71, None])])
    out = {r["class"]: r.cnt for r in raster.class_histogram(df, "v").collect()}
    assert out == {raster.CLASS_NAMES[0]: 2, raster.CLASS_NAMES[1]: 1, raster.CLASS_NAMES[2]: 1, raster.CLASS_NAMES[7]: 1, raster.CLASS_NAMES[8]: 1}


def test_write_back_and_stretch(spark):
    pixels = spark.createDataFrame([(0, 0, 1, 5.0), (1, 0, 1, 0.0), (2, 0, 2, 7.0)], "x int, y int, seg int, b double")
    labels = spark.createDataFrame([(1, 4)], "seg int, cls int")
    out = raster.write_back(pixels, labels, ["seg"], "cls", "b")
    assert [r.cls for r in out.orderBy("x").collect()] == [4, -1, -1]
    flat = raster.percentile_stretch(grid(spark, [(0, 0, 2.0), (1, 0, 2.0)]), ["v"])
    assert [r.v for r in flat.collect()] == [None, None]


def test_rectangle_boundary_is_inside(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.01, 0.5), (0.5, 0.5)], "x double, y double")
    assert spatial.in_rectangle(df, "x", "y", (0.0, 1.0, 0.0, 1.0)).count() == 3
    path = fresh_path(spark, "cells")
    spatial.write_cells(df, "x", "y", 0.3, path)
    found = spatial.in_rectangle_by_cell(spark.read.parquet(path), "x", "y", (0.0, 1.0, 0.0, 1.0), 0.3)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell_x" in plan and "GreaterThanOrEqual(cell_y,0)" in plan


def test_point_in_concave_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    polygons = spark.createDataFrame([(7, ring), (8, ring[:2])], "polygon_id int, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(1, 2.0, 0.5), (2, 2.0, 2.0), (3, 0.5, 2.5), (4, 5.0, 1.0), (5, 3.5, 2.9)], "i int, x double, y double")
    found = spatial.point_in_polygon(points, polygons, "x", "y")
    assert sorted((r.i, r.polygon_id) for r in found.collect()) == [(1, 7), (3, 7), (5, 7)]


def test_polygons_of_all_sizes_against_every_edge(spark):
    """A star with many edges, a huge box and a tiny one: cells on the outline and whole cells give what all edges give."""
    rng = random.Random(6)
    star = [(50 + (40 if k % 2 else 15) * math.cos(k * math.pi / 30), 50 + (40 if k % 2 else 15) * math.sin(k * math.pi / 30)) for k in range(60)]
    shapes = {1: star, 2: [(-900.0, -900.0), (900.0, -900.0), (900.0, 900.0), (-900.0, 900.0)], 3: [(10.0, 10.0), (10.2, 10.0), (10.1, 10.3)]}
    spots = [(k, rng.uniform(0, 100), rng.uniform(0, 100)) for k in range(1500)] + [(2000 + k, 10 + k / 100, 10.05) for k in range(25)]

    def inside(x, y, ring):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hits += 1
        return hits % 2 == 1

    polygons = spark.createDataFrame(list(shapes.items()), "polygon_id int, ring array<struct<x: double, y: double>>")
    found = spatial.point_in_polygon(spark.createDataFrame(spots, "i int, x double, y double"), polygons, "x", "y")
    want = {(i, p) for i, x, y in spots for p, ring in shapes.items() if inside(x, y, ring)}
    assert {(r.i, r.polygon_id) for r in found.collect()} == want and found.count() == len(want)
    cover, _ = spatial.polygon_cells(polygons)
    assert cover.filter("_id = 2").count() <= 4 and cover.filter("_id = 1").agg(F.max(F.size("_edges"))).first()[0] < 60


def test_cells_of_few_and_of_many_edges_are_joined_apart(spark):
    """A join that is compiled tests few edges; a saw on one side has more of them than a cell may keep."""
    saw = [(10 + (k % 2) / 100, 2 + k / 1000) for k in range(100)]
    ring = [(0.0, 0.0), (10.0, 0.0), *saw, (10.0, 9.0), (0.0, 9.0)]
    box = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
    spots = [(i, i % 60 * 0.2 + 0.013, i // 60 * 0.2 + 0.017) for i in range(3600)] + [(4000 + i, 10 + i % 20 / 2000, 2 + i / 4000) for i in range(400)]

    def inside(x, y, ring):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) % 2 == 1

    points = spark.createDataFrame(spots, "i int, x double, y double")
    for shapes, joins in (({1: box}, 1), ({1: box, 2: ring}, 2)):
        polygons = spark.createDataFrame(list(shapes.items()), "polygon_id int, ring array<struct<x: double, y: double>>")
        found = spatial.point_in_polygon(points, polygons, "x", "y")
        plan = found._jdf.queryExecution().executedPlan().toString()
        tests = [line for line in plan.splitlines() if "SortMergeJoin" in line]
        assert len(tests) == joins and sum("lambda" in line for line in tests) == joins - 1, tests
        assert {(r.i, r.polygon_id) for r in found.collect()} == {(i, p) for i, x, y in spots for p, ring in shapes.items() if inside(x, y, ring)}


def test_polygons_of_one_file_are_cut_in_many_tasks(spark):
    path = fresh_path(spark, "one")
    rows = [(i, [(i + 0.1, 0.0), (i + 0.7, 0.3), (i + 0.2, 0.9)]) for i in range(40)]
    spark.createDataFrame(rows, "polygon_id int, ring array<struct<x: double, y: double>>").coalesce(1).write.parquet(path)
    cover, _ = spatial.polygon_cells(spark.read.parquet(path))
    assert cover.select(F.input_file_name()).distinct().count() > 1


def test_reprojection_against_known_point(spark):
    # on the middle meridian the northing is the scaled meridian arc: 4984944.378 m up to 45 degrees
    df = spark.createDataFrame([(45.0, 3.0)], "lat double, lon double")
    g = spatial.wgs84_to_utm(df, "lat", "lon").first()
    assert abs(g.east - 500000) < 1e-3 and abs(g.north - 0.9996 * 4984944.378) < 1e-2
    df = spark.createDataFrame([(48.8584, 2.2945)], "lat double, lon double")
    back = spatial.utm_to_wgs84(spatial.wgs84_to_utm(df, "lat", "lon").select("east", "north"), "east", "north").first()
    assert math.isclose(back.lat, 48.8584, abs_tol=1e-8) and math.isclose(back.lon, 2.2945, abs_tol=1e-8)


def test_series_calendar(spark):
    rows = [(1, "2024-01-01", 1.0), (2, "2024-01-01", 2.0), (2, "2024-01-04", 3.0)]
    df = spark.createDataFrame(rows, "p int, s string, v double").select("p", F.to_date("s").alias("d"), "v")
    full = series.complete(df, "p", "d")
    assert sorted((r.p, str(r.d), r.v) for r in full.collect()) == [
        (1, "2024-01-01", 1.0), (1, "2024-01-04", None), (2, "2024-01-01", 2.0), (2, "2024-01-04", 3.0)
    ] or full.count() == 4
    assert series.drop_sparse_dates(df, "p", "d", "v", 0.6).select("d").distinct().count() == 1


def test_few_points_near_a_small_ring_are_tested(spark):
    """Cells of a ring with few edges are cut too, so that most points outside it share no cell with it."""
    ring = [(5.0, 1.0), (9.0, 5.0), (5.0, 9.0), (1.0, 5.0)]
    polygons = spark.createDataFrame([(1, ring)], "polygon_id int, ring array<struct<x: double, y: double>>")
    cover, _ = spatial.polygon_cells(polygons, cuts=spatial.CUTS)
    area = cover.selectExpr("sum(pow(4.0, _level)) AS a").first().a
    assert area < 4 * 32  # the ring has 32; its cells had 256 before they were cut
    spots = [(i, i % 40 * 0.25 + 0.1, i // 40 * 0.25 + 0.07) for i in range(1600)]
    found = spatial.point_in_polygon(spark.createDataFrame(spots, "i int, x double, y double"), polygons, "x", "y")
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.i for r in found.collect()) == [i for i, x, y in spots if abs(x - 5) + abs(y - 5) < 4]
