"""Run every query against its SQL: ``python tests/check_all.py DIR [KEY=VALUE...] [NAME...]``.

``KEY=VALUE`` are Spark settings, such as ``spark.sql.autoBroadcastJoinThreshold=-1``;
``BROADCAST_ROWS=0`` makes every checked join take its salted form.
"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from annualis import session  # noqa: E402
from annualis.session import build_session  # noqa: E402
from tests.parity import compare, connect  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", spark_sql_shuffle_partitions=8, spark_driver_memory="16g", spark_ui_enabled="false",
                          spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    for setting in [n for n in names if "=" in n]:
        key, value = setting.split("=", 1)
        if key == "BROADCAST_ROWS":
            session.BROADCAST_ROWS = int(value)
        else:
            spark.conf.set(key, value)
    names = [n for n in names if "=" not in n]
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            with session.scratch_scope(spark):
                df = run(spark, sf_dir)
                if name in sql:
                    problems = compare(df, con, sql[name])
                    state = "ok" if not problems else "DIFF " + "; ".join(problems)
                else:
                    state = f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            state = "ERROR " + str(e).strip()[:700]
            if names:
                traceback.print_exc()
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{time.time() - start:6.2f}s {name}: {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
