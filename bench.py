"""Times the headline queries on one machine and prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     cores (default: all)
BENCH_QUERIES  comma-separated names, or `all` (default: the headline list)
BENCH_RUNS     runs of each query, of which the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkdeck.plans import QUERIES  # noqa: E402
from sparkdeck.session import scratch, session  # noqa: E402

HEADLINE = [
    "a23_upsert",
    "b20_random_split",
    "c02_item_rating_range",
    "c12_interval_label",
    "c13_prior_mean_by_code",
    "c15_names_for_both_sides",
    "d04_word_count_any_case",
    "d05_extremes_and_distinct",
    "d07_mean_by_key_min_count",
    "d22_median_by_group",
    "e01_state_run_length",
    "e04_top_per_key",
    "h03_clean_product_text",
    "h27_access_log",
    "i04_windowed_word_count",
    "k02_correlation",
    "l07_tf_idf",
    "m04_multinomial_logistic",
    "m06_random_forest",
    "m17_auc",
    "n01_factor_model",
    "n05_items_for_all_users",
    "n08_most_similar",
    "n09_text_search",
    "o07_band_assembly",
    "o09_tile_stats",
    "o16_zonal_stats",
    "o22_median_filter",
    "p04_points_in_polygons",
    "q03_interpolate_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{tempfile.mkdtemp(prefix='bench-')}",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine
    seconds = {}
    for name in names:
        took = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            with scratch(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(median(took), 3)
        if os.environ.get("BENCH_TRACE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
