"""Run query cases against DuckDB from the command line: python -m tests.check [name part ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from millrace.plans.registry import CASES  # noqa: E402
from millrace.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(parts):
    folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", master="local[8]", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    entry.queries()
    bad = 0
    names = [n for n in CASES if not parts or any(p in n for p in parts)]
    for name in names:
        one = CASES[name]
        start = time.time()
        try:
            df = one.run(spark, folder)
            if one.sql is None:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
            else:
                problems = compare(df, con, one.sql)
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - start
        if problems or took > 4:
            print(f"{'BAD' if problems else 'slow'} {name} {took:.1f}s")
        if problems:
            bad += 1
            for p in problems:
                print("   ", p[:900])
    print(f"{len(names) - bad}/{len(names)} good")


if __name__ == "__main__":
    main(sys.argv[1:])
