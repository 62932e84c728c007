"""Run every query next to its SQL and print time and differences: ``check_queries.py [dir] [name…]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from panelcast.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), contract.oracle_sql()
    failed = []
    for name in names:
        begin = time.time()
        try:
            df = contract.queries()[name](spark, sf_dir)
            found = differences(df, con, sql[name]) if name in sql else [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - begin:.2f}s", *found, sep="\n     " if found else " ", flush=True)
        if found:
            failed.append(name)
    print("failed:", failed)
