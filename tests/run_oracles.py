"""Compare registered queries with their SQL: python tests/run_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import tempfile
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402

from tallyward.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracles", "local[8]", **{
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracles-"), "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                result = f"rows only: {len(df.collect())}"
            else:
                result = differences(df, con, sql) or "ok"
        except Exception:
            result = "error " + traceback.format_exc()[-900:]
        if not (result == "ok" or result.startswith("rows only")):
            bad.append(name)
        print(f"{name:28s} {time.time() - start:6.1f}s  {result[:900]}", flush=True)
    print(f"{len(names)} queries, {len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
