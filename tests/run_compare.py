"""Command line: compare registered queries with their SQL twins.

usage: python tests/run_compare.py FOLDER [query ...]
"""

import sys
import time

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from panelspark.session import local_session  # noqa: E402

if __name__ == "__main__":
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else None
            note = "" if name in sql else f"rows only: {df.count()}"
            if not sql.get(name) and wanted:
                df.show(20, False)
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - start:6.2f}s {note}{problem or ''}", flush=True)
    print("failures:", bad)
