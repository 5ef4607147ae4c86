"""Runs registered queries against their SQL: python tests/run_oracles.py [folder] [name prefix ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import __spark_entry__ as contract  # noqa: E402
from oracle import compare, duck  # noqa: E402

from ludolake.session import build_session  # noqa: E402


def main(folder="/root/testdata/sf0.01", *prefixes):
    spark = build_session("oracles", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad, total = duck(folder), contract.oracle_sql(), [], 0
    for name, run in contract.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        total += 1
        start = time.time()
        try:
            if name in sqls:
                problem = compare(run(spark, folder), con, sqls[name])
            else:
                rows = run(spark, folder).collect()
                problem = None if rows else "no rows"
                print("   ", name, "rows only:", len(rows), rows[:2])
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error)).strip()[:1500]
        if problem:
            bad.append(name)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{total - len(bad)} of {total} agree; not: {bad}")


if __name__ == "__main__":
    main(*sys.argv[1:])
