"""Raster, spatial and parcel-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import haversine
from ..operators import ordered, raster, reconstruct, series, spatial, stats
from ..session import fresh_path, stored
from .registry import query

NDVI = "SELECT *, CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END AS ndvi FROM v_pixels"
NDVI2 = "SELECT *, CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END AS ndvi FROM v_pixels2"


def ndvi(pixels, cap=None):
    return raster.normalized_difference(pixels, "nir", "red", "ndvi", cap)


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query(
    "o01_cell_and_tile_counts",
    "SELECT count(*) AS cells, count(DISTINCT tile_col * 100000 + tile_row) AS tiles FROM v_pixels",
)
def cell_and_tile_counts(t):
    per = t.v_pixels.groupBy("tile_col", "tile_row").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("cells"), F.count(F.lit(1)).alias("tiles"))


@query(
    "o02_tile_layout",
    """SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(tile_col) AS min_tile_col,
              max(tile_col) AS max_tile_col, min(tile_row) AS min_tile_row, max(tile_row) AS max_tile_row FROM v_pixels""",
)
def tile_layout(t):
    return raster.layer_extent(raster.tile_keys(t.v_pixels.select("x", "y"), 16, 16))


@query("o03_double_with_nodata", "SELECT x, y, CASE WHEN red <> 0 THEN red END AS red FROM v_pixels")
def double_with_nodata(t):
    cells = t.v_pixels.select("x", "y", F.col("red").cast("int").alias("red"))
    return raster.to_double(cells, ["red"], 0)


@query("o04_normalised_difference", f"SELECT x, y, ndvi FROM ({NDVI})")
def normalised_difference(t):
    return ndvi(t.v_pixels).select("x", "y", "ndvi")


@query(
    "o05_other_band_pairs",
    """SELECT x, y, CASE WHEN "B3" + "B4" <> 0 THEN ("B3" - "B4") / ("B3" + "B4") END AS grvi,
              CASE WHEN "B3" + "B5" <> 0 THEN ("B3" - "B5") / ("B3" + "B5") END AS ndwi FROM (
         SELECT x, y, max(CASE WHEN band = 'B3' THEN value END) AS "B3", max(CASE WHEN band = 'B4' THEN value END) AS "B4",
                max(CASE WHEN band = 'B5' THEN value END) AS "B5" FROM v_bands GROUP BY x, y)""",
)
def other_band_pairs(t):
    cells = raster.assemble_bands(t.v_bands, ["B3", "B4", "B5"])
    out = raster.normalized_difference(raster.normalized_difference(cells, "B3", "B4", "grvi"), "B3", "B5", "ndwi")
    return out.select("x", "y", "grvi", "ndwi")


@query(
    "o06_two_date_difference",
    f"""SELECT a.x, a.y, CASE WHEN a.ndvi < 0 THEN -99 ELSE a.ndvi END - b.ndvi AS diff
        FROM ({NDVI2}) a JOIN ({NDVI}) b ON a.x = b.x AND a.y = b.y""",
)
def two_date_difference(t):
    return raster.raster_diff(ndvi(t.v_pixels2), ndvi(t.v_pixels), "ndvi")


@query(
    "o07_band_assembly",
    """SELECT scene, x, y, max(CASE WHEN band = 'B3' THEN value END) AS "B3", max(CASE WHEN band = 'B4' THEN value END) AS "B4",
              max(CASE WHEN band = 'B5' THEN value END) AS "B5" FROM v_bands GROUP BY scene, x, y""",
)
def band_assembly(t):
    return raster.assemble_bands(t.v_bands, ["B3", "B4", "B5"])


def _stretch_sql(b):
    return f"""CASE WHEN {b} = 0 THEN {b} ELSE round((least(greatest({b}, 4000), 15176) - 4000) / 11176.0 * 255, 6) END AS {b}"""


@query("o08_composite", f"SELECT x, y, {_stretch_sql('red')}, {_stretch_sql('nir')} FROM v_pixels")
def composite(t):
    return raster.composite(t.v_pixels.select("x", "y", "red", "nir"), ["red", "nir"]).select("x", "y", *r6("red", "nir"))


def _tile_rule(stat, sentinel, min_nan):
    gaps = "count(*) - count(ndvi)"
    return f"CASE WHEN {gaps} >= {min_nan} THEN {sentinel} WHEN {gaps} = 0 THEN round({stat}, 6) END"


def _tile_sql(min_nan):
    return f"""SELECT tile_col, tile_row, min(x) AS xmin, min(y) AS ymin, max(x) + 1 AS xmax, max(y) + 1 AS ymax,
        {_tile_rule('min(ndvi)', -2147483648.0, min_nan)} AS min, {_tile_rule('max(ndvi)', -2147483648.0, min_nan)} AS max,
        {_tile_rule('avg(ndvi)', -2147483648.0, min_nan)} AS mean, {_tile_rule('stddev_pop(ndvi)', 0.0, min_nan)} AS std
        FROM ({NDVI}) GROUP BY 1, 2"""


def _tiles(t, min_nan):
    out = raster.tile_stats(ndvi(t.v_pixels), "ndvi", min_nan)
    return out.select("tile_col", "tile_row", "xmin", "ymin", "xmax", "ymax", *r6("min", "max", "mean", "std"))


@query("o09_tile_stats", _tile_sql(2))
def tile_stats(t):
    return _tiles(t, 2)


@query("o09_tile_stats_any_gap", _tile_sql(1))
def tile_stats_any_gap(t):
    return _tiles(t, 1)


@query(
    "o10_tile_mean_fill",
    f"SELECT x, y, round(avg(ndvi) OVER (PARTITION BY tile_col, tile_row), 6) AS mean FROM ({NDVI})",
)
def tile_mean_fill(t):
    return raster.tile_mean_fill(ndvi(t.v_pixels), "ndvi", "mean").select("x", "y", *r6("mean"))


def _class_sql():
    steps = " ".join(f"WHEN ndvi <= {e} THEN '{n}'" for e, n in zip(raster.CLASS_EDGES, raster.CLASS_NAMES))
    return f"CASE {steps} ELSE '{raster.CLASS_NAMES[-1]}' END"


@query(
    "o11_class_histogram",
    f"""SELECT 's1' AS scene, {_class_sql()} AS class, count(*) AS cnt FROM ({NDVI}) WHERE ndvi IS NOT NULL GROUP BY 2""",
)
def class_histogram(t):
    return raster.class_histogram(ndvi(t.v_pixels).withColumn("scene", F.lit("s1")), "ndvi", by=["scene"])


@query(
    "o15_mosaic",
    """SELECT x, y, arg_max(v, p) AS v FROM (SELECT x, y, red AS v, 1 AS p FROM v_pixels UNION ALL
         SELECT x + 64, y, nir, 2 FROM v_pixels2) GROUP BY x, y""",
)
def mosaic(t):
    a = t.v_pixels.select("x", "y", F.col("red").alias("v"), F.lit(1).alias("p"))
    b = t.v_pixels2.select((F.col("x") + 64).alias("x"), "y", F.col("nir").alias("v"), F.lit(2).alias("p"))
    return raster.mosaic(a.unionByName(b), "v", "p")


@query(
    "o16_zonal_stats",
    f"""SELECT zone, round(min(ndvi), 6) AS min, round(max(ndvi), 6) AS max, round(avg(ndvi), 6) AS mean,
               round(median(ndvi), 6) AS median, round(stddev_pop(ndvi), 6) AS std
        FROM (SELECT *, tile_row * 10 + floor(tile_col / 4)::BIGINT AS zone FROM ({NDVI})) GROUP BY zone""",
)
def zonal_stats(t):
    zoned = ndvi(t.v_pixels).withColumn("zone", F.col("tile_row") * 10 + F.floor(F.col("tile_col") / 4))
    return raster.zonal_stats(zoned, "zone", "ndvi").select("zone", *r6("min", "max", "mean", "median", "std"))


@query(
    "o16_zonal_stats_of_polygons",
    f"""SELECT zone, round(min(ndvi), 6) AS min, round(max(ndvi), 6) AS max, round(avg(ndvi), 6) AS mean,
               round(median(ndvi), 6) AS median, round(stddev_pop(ndvi), 6) AS std, count(ndvi) AS n
        FROM ({NDVI}) JOIN (SELECT s_suppkey AS zone, s_suppkey * 37 % 128 + 0.25 AS cx, s_suppkey * 53 % 100 + 0.25 AS cy FROM supplier)
          ON abs(x - cx) + abs(y - cy) < 9.1 GROUP BY zone""",
)
def zonal_stats_of_polygons(t):
    """Figures of the pixels whose centres lie in each polygon; polygons may overlap."""
    cx, cy = (F.col("s_suppkey") * 37 % 128) + 0.25, (F.col("s_suppkey") * 53 % 100) + 0.25
    corners = [F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in ((9.1, 0), (0, 9.1), (-9.1, 0), (0, -9.1))]
    zones = t.supplier.select(F.col("s_suppkey").alias("zone"), F.array(*corners).alias("ring"))
    placed = spatial.point_in_polygon(ndvi(t.v_pixels).select("x", "y", "ndvi"), zones, "x", "y", "zone")
    placed = stored(placed.select("zone", "ndvi"), "placed")
    out = raster.zonal_stats(placed, "zone", "ndvi").select("zone", *r6("min", "max", "mean", "median", "std"))
    return out.join(placed.groupBy("zone").agg(F.count("ndvi").alias("n")), "zone")


_DATES = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-11", "2024-01-20"]


@query(
    "o17_temporal_table",
    "SELECT parcel, "
    + ", ".join(f"max(CASE WHEN d = DATE '{d}' THEN v END) AS \"{d.replace('-', '')}\"" for d in _DATES)
    + " FROM v_series GROUP BY parcel",
)
def temporal_table(t):
    return series.pivot_dates(t.v_series, "parcel", "d", "v", _DATES)


_SEG = ["tile_col", "tile_row"]


@query(
    "o18_segment_features",
    """SELECT a.*, b.red_mean_2, b.red_std_2, b.nir_mean_2, b.nir_std_2 FROM
       (SELECT tile_col, tile_row, round(avg(red), 6) AS red_mean_1, round(stddev_pop(red), 6) AS red_std_1,
               round(avg(nir), 6) AS nir_mean_1, round(stddev_pop(nir), 6) AS nir_std_1 FROM v_pixels GROUP BY 1, 2) a JOIN
       (SELECT tile_col, tile_row, round(avg(red), 6) AS red_mean_2, round(stddev_pop(red), 6) AS red_std_2,
               round(avg(nir), 6) AS nir_mean_2, round(stddev_pop(nir), 6) AS nir_std_2 FROM v_pixels2 GROUP BY 1, 2) b
       USING (tile_col, tile_row)""",
)
def segment_features(t):
    a = raster.segment_features(t.v_pixels, _SEG, ["red", "nir"], "_1")
    b = raster.segment_features(t.v_pixels2, _SEG, ["red", "nir"], "_2")
    out = a.join(b, _SEG)
    return out.select(*_SEG, *r6(*[c for c in out.columns if c not in _SEG]))


@query(
    "o19_label_write_back",
    """SELECT x, y, CASE WHEN red = 0 THEN -1 ELSE (tile_col + tile_row) % 6 END AS cls FROM v_pixels""",
)
def label_write_back(t):
    labels = t.v_pixels.select(*_SEG).distinct().withColumn("cls", (F.col("tile_col") + F.col("tile_row")) % 6)
    return raster.write_back(t.v_pixels, labels, _SEG, "cls", "red").select("x", "y", "cls")


@query(
    "o20_training_pixels",
    """SELECT a.x, a.y, a.red AS red_1, a.nir AS nir_1, b.red AS red_2, b.nir AS nir_2,
              CAST(floor(a.red / 2500) AS BIGINT) AS label
       FROM v_pixels a JOIN v_pixels2 b ON a.x = b.x AND a.y = b.y WHERE floor(a.red / 2500) > 0""",
)
def training_pixels(t):
    a = t.v_pixels.withColumn("label", F.floor(F.col("red") / 2500)).filter("label > 0")
    first = a.select("x", "y", F.col("red").alias("red_1"), F.col("nir").alias("nir_1"), "label")
    second = t.v_pixels2.select("x", "y", F.col("red").alias("red_2"), F.col("nir").alias("nir_2"))
    return first.join(second, ["x", "y"])


@query(
    "o22_median_filter",
    """WITH c AS (SELECT x, y, CASE WHEN red <> 0 THEN (tile_col + floor(red / 1000)::BIGINT) % 7 END AS cls FROM v_pixels),
         o AS (SELECT x, y, dx, dy FROM c, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy) WHERE cls IS NOT NULL),
         e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM c)
       SELECT c.x, c.y, m FROM c LEFT JOIN (SELECT o.x, o.y, median(n.cls) AS m FROM o, e, c n
         WHERE n.x = least(greatest(o.x + dx, x0), x1) AND n.y = least(greatest(o.y + dy, y0), y1) AND n.cls IS NOT NULL
         GROUP BY 1, 2) f ON f.x = c.x AND f.y = c.y""",
)
def median_filter(t):
    cls = (F.col("tile_col") + F.floor(F.col("red") / 1000)) % 7
    cells = t.v_pixels.select("x", "y", F.when(F.col("red") != 0, cls).alias("cls"))
    return raster.median_filter(cells, "cls", out="m").select("x", "y", "m")


@query(
    "o23_cap_at_one",
    """SELECT x, y, CASE WHEN v > 1 THEN 1 ELSE v END AS v FROM
       (SELECT x, y, CASE WHEN nir + red - 9000 <> 0 THEN (nir - red + 9000) / (nir + red - 9000) END AS v FROM v_pixels)""",
)
def cap_at_one(t):
    # a shifted red band takes the index beyond 1
    cells = t.v_pixels.select("x", "y", "nir", (F.col("red") - 9000).alias("red"))
    return ndvi(cells, cap=1.0).select("x", "y", F.col("ndvi").alias("v"))


@query(
    "o24_overlay",
    """SELECT a.x, a.y, CASE WHEN (a.x % 4) > 0 AND b.x IS NOT NULL THEN (a.x % 4)::DOUBLE ELSE a.red END AS shown
       FROM v_pixels a LEFT JOIN v_pixels2 b ON a.x = b.x AND a.y = b.y""",
)
def overlay(t):
    labels = t.v_pixels2.select("x", "y", (F.col("x") % 4).cast("double").alias("label"))
    return raster.overlay(t.v_pixels, labels, "red", "label", "shown").select("x", "y", "shown")


@query(
    "k08_percentile_stretch",
    """SELECT x, y, round((least(greatest(nir, lo), hi) - lo) / (hi - lo), 6) AS nir FROM v_pixels,
       (SELECT quantile_cont(nir, 0.02) AS lo, quantile_cont(nir, 0.98) AS hi FROM v_pixels)""",
)
def percentile_stretch(t):
    return raster.percentile_stretch(t.v_pixels.select("x", "y", "nir"), ["nir"]).select("x", "y", *r6("nir"))


@query(
    "l12_mean_imputation",
    f"""SELECT x, y, round(coalesce(ndvi, (SELECT avg(ndvi) FROM ({NDVI}))), 6) AS ndvi FROM ({NDVI})""",
)
def mean_imputation(t):
    return raster.impute_mean(ndvi(t.v_pixels).select("x", "y", "ndvi"), ["ndvi"]).select("x", "y", *r6("ndvi"))


@query(
    "l14_two_date_features",
    """SELECT a.x, a.y, a.red, a.nir, b.red AS red_later, b.nir AS nir_later FROM v_pixels a JOIN v_pixels2 b
       ON a.x = b.x AND a.y = b.y""",
)
def two_date_features(t):
    later = t.v_pixels2.select("x", "y", F.col("red").alias("red_later"), F.col("nir").alias("nir_later"))
    return t.v_pixels.select("x", "y", "red", "nir").join(later, ["x", "y"])


# --- points ------------------------------------------------------------------------------------------

# an own rectangle over the sample points
RECT = (-113.79, -109.73, 32.99, 35.08)
_IN = "lon BETWEEN -113.79 AND -109.73 AND lat BETWEEN 32.99 AND 35.08"


@query("p01_points_in_rectangle", f"SELECT event_id, lon, lat FROM v_points WHERE {_IN}")
def points_in_rectangle(t):
    return spatial.in_rectangle(t.v_points, "lon", "lat", RECT)


@query("p02_rectangle_by_cell", f"SELECT count(*) AS n FROM v_points WHERE {_IN}")
def rectangle_by_cell(t):
    path = fresh_path(t.spark, "cells")
    spatial.write_cells(t.v_points, "lon", "lat", 0.5, path)
    located = t.spark.read.parquet(path)
    return spatial.in_rectangle_by_cell(located, "lon", "lat", RECT, 0.5).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p03_nearest_points",
    """SELECT event_id, round(sqrt(pow(lon + 110, 2) + pow(lat - 33, 2)), 6) AS dist FROM v_points
       ORDER BY sqrt(pow(lon + 110, 2) + pow(lat - 33, 2)), event_id LIMIT 12""",
)
def nearest_points(t):
    path = fresh_path(t.spark, "cells")
    spatial.write_cells(t.v_points, "lon", "lat", 0.5, path)
    out = spatial.knn_by_cell(t.spark.read.parquet(path), "lon", "lat", -110.0, 33.0, 12, "event_id", 0.5)
    return out.select("event_id", F.round("dist", 6).alias("dist"))


@query(
    "p04_points_in_polygons",
    """SELECT event_id, s_suppkey AS polygon_id FROM v_points JOIN
         (SELECT s_suppkey, -116 + (s_suppkey * 37 % 100) / 10.0 AS cx, 30 + (s_suppkey * 53 % 70) / 10.0 + 0.003 AS cy
          FROM supplier) ON abs(lon - (cx + 0.0051)) + abs(lat - cy) < 0.4""",
)
def points_in_polygons(t):
    cx = F.lit(-116.0) + (F.col("s_suppkey") * 37 % 100) / 10 + 0.0051
    cy = F.lit(30.0) + (F.col("s_suppkey") * 53 % 70) / 10 + 0.003

    def corner(dx, dy):
        return F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))

    ring = F.array(corner(0.4, 0), corner(0, 0.4), corner(-0.4, 0), corner(0, -0.4))
    diamonds = t.supplier.select(F.col("s_suppkey").alias("polygon_id"), ring.alias("ring"))
    found = spatial.point_in_polygon(t.v_points, diamonds, "lon", "lat")
    return found.select("event_id", "polygon_id")


_KM = """2 * 6372.8 * asin(sqrt(least(1.0, pow(sin(radians(33.3 - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(33.3)) * pow(sin(radians(-111.2 - lon) / 2), 2))))"""


@query("p05_within_distance", f"SELECT event_id, round({_KM}, 5) AS km FROM v_points WHERE {_KM} <= 120")
def within_distance(t):
    out = spatial.within_km(t.v_points, "lat", "lon", 33.3, -111.2, 120.0)
    return out.select("event_id", F.round("km", 5).alias("km"))


@query("p06_reproject", "SELECT event_id, round(lat + 14, 6) AS lat, round(lon + 114, 6) AS lon FROM v_points")
def reproject(t):
    # points moved into the zone, projected to the grid and back
    moved = t.v_points.select("event_id", (F.col("lat") + 14).alias("lat"), (F.col("lon") + 114).alias("lon"))
    grid = spatial.wgs84_to_utm(moved, "lat", "lon").select("event_id", "east", "north")
    back = spatial.utm_to_wgs84(grid, "east", "north")
    return back.select("event_id", *r6("lat", "lon"))


@query(
    "h21_great_circle",
    f"SELECT event_id, round({_KM}, 4) AS km FROM v_points",
)
def great_circle(t):
    km = haversine(F.col("lat"), F.col("lon"), F.lit(33.3), F.lit(-111.2))
    return t.v_points.select("event_id", F.round(km, 4).alias("km"))


@query(
    "p07_nearest_place",
    f"""SELECT event_id, place, round(km, 4) AS km FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY km, place) AS r
        FROM (SELECT event_id, 'a' AS place, {_KM} AS km FROM v_points UNION ALL
              SELECT event_id, 'b', {_KM.replace('33.3', '31.1').replace('-111.2', '-108.4')} FROM v_points)) WHERE r = 1""",
)
def nearest_place(t):
    table = spatial.distances_to(t.v_points, "lat", "lon", [("a", 33.3, -111.2), ("b", 31.1, -108.4)])
    best = F.min_by(F.struct("place", "km"), F.struct("km", "place")).alias("b")
    near = table.groupBy("event_id").agg(best)
    return near.select("event_id", "b.place", F.round("b.km", 4).alias("km"))


# --- series ------------------------------------------------------------------------------------------

_GAPS = """SELECT d, (SELECT count(DISTINCT parcel) FROM v_series) - count(*) AS missing, count(*) AS present
           FROM v_series GROUP BY d"""


@query(
    "q01_missing_per_date",
    f"""SELECT strftime(d, '%Y-%m-%d') AS day, 'missing' AS kind, missing AS n FROM ({_GAPS}) UNION ALL
        SELECT strftime(d, '%Y-%m-%d'), 'present', present FROM ({_GAPS})""",
)
def missing_per_date(t):
    out = series.missing_per_date(t.v_series, "parcel", "d", "v")
    return out.select(F.date_format("d", "yyyy-MM-dd").alias("day"), "kind", "n")


_KEPT = f"""SELECT d FROM ({_GAPS}) WHERE missing < floor(0.6 * (SELECT count(DISTINCT parcel) FROM v_series))"""


@query(
    "q02_drop_sparse_dates",
    f"SELECT parcel, strftime(d, '%Y-%m-%d') AS day, v FROM v_series WHERE d IN ({_KEPT})",
)
def drop_sparse_dates(t):
    out = series.drop_sparse_dates(stored(t.v_series, "series"), "parcel", "d", "v", 0.6)
    return out.select("parcel", F.date_format("d", "yyyy-MM-dd").alias("day"), "v")


def _fill_sql(x):
    return f"""WITH grid AS (SELECT parcel, d FROM (SELECT DISTINCT parcel FROM v_series), ({_KEPT})),
      full_rows AS (SELECT grid.parcel, grid.d, v, {x} AS x FROM grid LEFT JOIN v_series s
                    ON s.parcel = grid.parcel AND s.d = grid.d),
      marked AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER before AS x0,
                 last_value(v IGNORE NULLS) OVER before AS v0,
                 first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER after AS x1,
                 first_value(v IGNORE NULLS) OVER after AS v1 FROM full_rows
          WINDOW before AS (PARTITION BY parcel ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 after AS (PARTITION BY parcel ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
      SELECT parcel, strftime(d, '%Y-%m-%d') AS day, round(CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NULL THEN NULL
        WHEN v1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (x - x0) / (x1 - x0) END, 9) AS v FROM marked"""


def _filled(t, by_time):
    kept = stored(series.drop_sparse_dates(stored(t.v_series, "series"), "parcel", "d", "v", 0.6), "kept")
    full = series.complete(kept, "parcel", "d")
    out = ordered.interpolate(full, ["parcel"], "d", "v", by_time=by_time)
    return out.select("parcel", F.date_format("d", "yyyy-MM-dd").alias("day"), F.round("v", 9).alias("v"))


@query("q03_interpolate_rows", _fill_sql("row_number() OVER (PARTITION BY grid.parcel ORDER BY grid.d)"))
def interpolate_rows(t):
    return _filled(t, False)


@query(
    "q04_reconstruct_from_alike",
    """WITH s AS (SELECT parcel, d, v FROM v_series),
         gaps AS (SELECT parcel, d FROM (SELECT DISTINCT parcel FROM s) CROSS JOIN (SELECT DISTINCT d FROM s) EXCEPT SELECT parcel, d FROM s),
         far AS (SELECT a.parcel AS p, b.parcel AS o, avg((a.v - b.v) * (a.v - b.v)) AS dist
                 FROM s a JOIN s b ON a.d = b.d AND a.parcel <> b.parcel GROUP BY 1, 2),
         near AS (SELECT g.parcel, g.d, s.v, dist, row_number() OVER (PARTITION BY g.parcel, g.d ORDER BY dist, s.parcel) AS r
                  FROM gaps g JOIN s ON s.d = g.d JOIN far ON p = g.parcel AND o = s.parcel),
         new AS (SELECT parcel, d, CASE WHEN min(dist) = 0 THEN avg(CASE WHEN dist = 0 THEN v END)
                                        ELSE sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) END AS v FROM near WHERE r <= 5 GROUP BY 1, 2)
       SELECT parcel, strftime(d, '%Y-%m-%d') AS day, round(v, 6) AS v, false AS filled FROM s UNION ALL
       SELECT g.parcel, strftime(g.d, '%Y-%m-%d'), round(n.v, 6), n.v IS NOT NULL FROM gaps g LEFT JOIN new n ON n.parcel = g.parcel AND n.d = g.d""",
)
def reconstruct_from_alike(t):
    out = reconstruct.knn_fill(stored(t.v_series, "series"), "parcel", "d", "v", 5)
    return out.select("parcel", F.date_format("d", "yyyy-MM-dd").alias("day"), F.round("v", 6).alias("v"), "filled")


@query("e06_interpolate_time", _fill_sql("date_diff('day', DATE '2024-01-01', grid.d)"))
def interpolate_time(t):
    return _filled(t, True)


@query("f04_dates_in_order", """SELECT strftime(d, '%Y%m%d') AS name, n, row_number() OVER (ORDER BY d) AS pos
       FROM (SELECT d, count(*) AS n FROM v_series GROUP BY d)""")
def dates_in_order(t):
    named = t.v_series.groupBy(F.date_format("d", "yyyyMMdd").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    dated = named.withColumn("d", F.to_date("name", "yyyyMMdd"))
    return ordered.row_index(dated, [], ["d"], "pos").select("name", "n", "pos")


@query(
    "q05_state_and_counter",
    """SELECT user_id, max(run) AS longest FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) - 1
         AS run FROM (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM (
           SELECT *, CASE WHEN flag IS NULL THEN CASE WHEN state_b = lag(state_b) OVER w THEN 0 ELSE 1 END
                          ELSE CASE WHEN state_a = lag(state_a) OVER w THEN 0 ELSE 1 END END AS changed
           FROM v_sensor WINDOW w AS (PARTITION BY user_id ORDER BY event_id)))) GROUP BY user_id""",
)
def state_and_counter(t):
    runs = ordered.state_run_length(
        t.v_sensor, ["user_id"], ["event_id"], ["state_a"], when_null=("flag", ["state_b"])
    )
    return runs.groupBy("user_id").agg(F.max("run").alias("longest"))


@query(
    "q06_danger_by_scenario",
    """SELECT event_type, danger, count(*) AS n FROM (SELECT event_type, CAST(EXISTS (SELECT 1 FROM v_intervals i
         WHERE i.event_type = ev.event_type AND (CASE WHEN i.open_start THEN ev.ts > i.s ELSE ev.ts >= i.s END)
         AND ev.ts < i.e) AS INTEGER) AS danger FROM events ev) GROUP BY 1, 2""",
)
def danger_by_scenario(t):
    rows = t.events.select("event_id", "event_type", "ts")
    marked = ordered.covered(rows, t.v_intervals, ["event_type"], "ts", "danger")
    return marked.groupBy("event_type", "danger").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q07_truth_per_scenario",
    """SELECT source, quality, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'
       GROUP BY 1, 2, 3""",
)
def truth_per_scenario(t):
    scenes = t.documents.filter("lang = 'en'").select("doc_id", "source")
    return t.labels.join(scenes, "doc_id").groupBy("source", "quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


_RETURNS = """r AS (SELECT asset, month, (price - lag(price) OVER w) / lag(price) OVER w AS ret FROM v_monthly
                        WINDOW w AS (PARTITION BY asset ORDER BY month))"""


def _returns(t):
    return ordered.period_return(t.v_monthly, ["asset"], ["month"], "price")


@query(
    "q08_return_covariance",
    f"""WITH {_RETURNS}
        SELECT a.asset AS a, b.asset AS b, round(covar_samp(a.ret, b.ret), 8) AS value
        FROM r a JOIN r b ON a.month = b.month AND a.asset <= b.asset GROUP BY 1, 2""",
)
def return_covariance(t):
    """Covariance of every two assets over their common months."""
    return stats.cov_long(_returns(t), "asset", "month", "ret").withColumn("value", F.round("value", 8))


@query("k03_expected_return", f"WITH {_RETURNS} SELECT asset AS name, round(avg(ret), 8) AS mean FROM r GROUP BY asset")
def expected_return(t):
    return _returns(t).groupBy(F.col("asset").alias("name")).agg(F.round(F.avg("ret"), 8).alias("mean"))
