"""Tables of one data folder and the views derived from them.

View texts are plain SQL that both Spark and the checking database run unchanged, so a query and its
check start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS = {
    "v_ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               MAX(CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE)) AS rating
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey""",
    "v_pixels": """
        SELECT o_orderkey % 128 AS x,
               CAST((o_orderkey - o_orderkey % 128) / 128 AS BIGINT) AS y,
               CAST((o_orderkey % 128 - o_orderkey % 16) / 16 AS BIGINT) AS tile_col,
               CAST((o_orderkey - o_orderkey % 2048) / 2048 AS BIGINT) AS tile_row,
               CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST((o_orderkey * 7919) % 10007 AS DOUBLE) END AS red,
               CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 10007 AS DOUBLE) END AS nir
        FROM orders""",
    "v_pixels2": """
        SELECT x, y, tile_col, tile_row,
               CAST(CAST(red * 31 AS BIGINT) % 10007 AS DOUBLE) AS red,
               CAST(CAST(nir * 17 AS BIGINT) % 10007 AS DOUBLE) AS nir
        FROM v_pixels WHERE (x + y) % 53 <> 0""",
    "v_bands": """
        SELECT 's1' AS scene, x, y, 'B4' AS band, red AS value FROM v_pixels UNION ALL
        SELECT 's1', x, y, 'B5', nir FROM v_pixels UNION ALL
        SELECT 's1', x, y, 'B3', CAST(CAST(red + nir AS BIGINT) % 10007 AS DOUBLE) FROM v_pixels""",
    "v_points": """
        SELECT event_id, -116 + CAST((event_id * 7919) % 1000 AS DOUBLE) / 100 AS lon,
               30 + CAST((event_id * 104729) % 701 AS DOUBLE) / 100 AS lat FROM events""",
    "v_series": """
        SELECT user_id AS parcel, CAST(ts AS DATE) AS d, ROUND(AVG(value), 6) AS v
        FROM events WHERE EXTRACT(DAY FROM ts) % 10 <> 0 OR user_id % 4 = 0
        GROUP BY user_id, CAST(ts AS DATE)""",
    "v_clicks": """
        SELECT user_id AS vid, CAST(event_id % 200 AS STRING) AS pid,
               CASE event_type WHEN 'purchase' THEN 4 WHEN 'click' THEN 2 ELSE 1 END AS score,
               CASE WHEN user_id % 7 = 0 THEN '0' ELSE CAST(user_id + 1000 AS STRING) END AS uid,
               ts AS vts_last FROM events""",
    "v_json": """
        SELECT event_id, ts, CONCAT('{"idsite":"', CAST(user_id % 20 AS STRING), '","idgoal":"',
          CASE WHEN event_type IN ('purchase','click') THEN '0' ELSE '5' END,
          '","_id":"u', CAST(user_id AS STRING), '"',
          CASE WHEN event_type = 'purchase'
               THEN CONCAT(',"ec_id":"e', CAST(event_id AS STRING), '"') ELSE '' END,
          CASE WHEN event_type IN ('purchase','click')
               THEN CONCAT(',"ec_items":"[[', CHR(92), '"p', CAST(event_id % 200 AS STRING),
                           CHR(92), '",1]]"') ELSE '' END,
          '}') AS value FROM events""",
    "v_log_fields": """
        SELECT event_id, ts, CONCAT('10.0.0.', CAST(user_id % 250 AS STRING)) AS clientip,
               CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 302 ELSE 200 END AS response,
               CAST(FLOOR(value) AS BIGINT) AS bytes, CONCAT('/', event_type) AS request
        FROM events""",
    "v_upsert": "SELECT conv_id AS id, turn AS version, role AS label FROM conversations",
    "v_tsv": """
        SELECT event_id, CASE WHEN event_id % 50 = 0
          THEN CONCAT_WS(CHR(9), 'a','b','c', CAST(event_id % 2 AS STRING), CAST(user_id AS STRING),
               'f', event_type, 'h','i', CONCAT('u', CAST(user_id AS STRING), '@a.org'),
               'k','l','m','n','o','p','q')
          ELSE CONCAT_WS(CHR(9), 'a','b','c', CAST(event_id % 2 AS STRING),
               CAST(user_id AS STRING), 'f', event_type, 'h','i',
               CONCAT('u', CAST(user_id AS STRING),
                      CASE WHEN event_id % 20 = 1 THEN '@staff.example' ELSE '@a.org' END),
               'k','l','m','n','o','p','q','r') END AS line FROM events""",
    "v_intervals": """
        SELECT * FROM (VALUES
          ('click', CAST('2024-01-03 00:00:00' AS TIMESTAMP), CAST('2024-01-05 00:00:00' AS TIMESTAMP), false),
          ('click', CAST('2024-01-04 00:00:00' AS TIMESTAMP), CAST('2024-01-06 12:00:00' AS TIMESTAMP), false),
          ('error', CAST('2024-01-10 12:00:00' AS TIMESTAMP), CAST('2024-01-11 00:00:00' AS TIMESTAMP), true))
          AS t(event_type, s, e, open_start)""",
    # parcel time series as sensor rows: three 0/1/2 states with gaps, one row per user and event
    "v_sensor": """
        SELECT user_id, event_id, ts,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(FLOOR(value) AS BIGINT) % 3 END AS flag,
               CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 0 ELSE 1 END AS state_a,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 2 END AS state_b
        FROM events""",
    # article, season and colour/family/age style attributes from order lines
    "v_articles": """
        SELECT l_partkey AS article, EXTRACT(YEAR FROM l_shipdate) AS collection,
               p_brand AS colour, p_type AS family, CAST(p_size % 3 AS BIGINT) AS age,
               SUM(CAST(l_quantity AS BIGINT)) AS qty
        FROM lineitem JOIN part ON p_partkey = l_partkey
        GROUP BY l_partkey, EXTRACT(YEAR FROM l_shipdate), p_brand, p_type, p_size % 3""",
    "v_monthly": """
        SELECT CAST(EXTRACT(YEAR FROM o_orderdate) * 100 + EXTRACT(MONTH FROM o_orderdate) AS BIGINT) AS month,
               o_orderpriority AS asset, ROUND(AVG(o_totalprice), 4) AS price
        FROM orders GROUP BY 1, 2""",
}


def needs(sql: str) -> list[str]:
    """View names used by a text, dependencies first."""
    found: list[str] = []
    for name in re.findall(r"\bv_\w+", sql):
        if name in VIEWS and name not in found:
            for inner in needs(VIEWS[name]):
                if inner not in found:
                    found.append(inner)
            found.append(name)
    return found


def with_views(sql: str) -> str:
    """Prefix a query text with the views it uses."""
    names = needs(sql)
    if not names:
        return sql
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


class Tables:
    """Attribute access to base tables and views of one folder, each read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            df = self.spark.read.parquet(self.path(name))
        elif name in VIEWS:
            df = self.sql(VIEWS[name])
        else:
            raise AttributeError(name)
        self.__dict__[name] = df
        return df

    def sql(self, text: str) -> DataFrame:
        """Run a text over base tables and views by name."""
        for name in BASE:
            if re.search(rf"\b{name}\b", text):
                getattr(self, name).createOrReplaceTempView(name)
        for name in needs(text):
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(text)
