"""Command line: run registered queries against their checks, `python tests/run_checks.py [prefix…]`."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, database  # noqa: E402

from sparkdeck.plans import CHECKS, QUERIES  # noqa: E402
from sparkdeck.session import session  # noqa: E402


def main():
    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = session("checks", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    db = database(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if name in os.environ.get("SKIP", "").split(","):
            continue
        if sys.argv[1:] and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in CHECKS:
                message = compare(df, db, CHECKS[name])
            else:
                message = "" if df.count() > 0 else "no rows"
        except Exception as error:  # report and go on
            message = "ERROR " + str(error).split("JVM stacktrace")[0][:600]
        bad += bool(message)
        tag = "FAIL" if message else ("ok" if name in CHECKS else "rows")
        print(f"{tag:4} {time.time() - start:6.1f}s {name} {message}", flush=True)
    print("bad", bad)


main()
