"""Run registered queries against DuckDB: check_all.py SF_DIR [name ...]."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tests.compare import connect, differences  # noqa: E402
from voltide.plans.queries import ORACLES, QUERIES  # noqa: E402
from voltide.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN"):  # a session without this library's settings
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = local_session(8)
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                problems, note = differences(df, con, ORACLES[name]), "sql"
            else:
                n = df.count()
                problems, note = ([] if n else ["no rows"]), f"rows {n}"
        except Exception as e:
            problems, note = [f"{type(e).__name__}: {str(e)[:1500]}"], "error"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - start
        print(f"{'ok  ' if not problems else 'FAIL'} {name:28s} {took:6.2f}s {note}", flush=True)
        for p in problems:
            print("    " + p)
        bad += bool(problems)
    print(f"{len(names) - bad}/{len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 99))
