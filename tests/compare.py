"""Run queries and their SQL side by side: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql) -> str | None:
    """What differs between a query and its SQL, or None. Values must be equal, not close."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            close = all(x == y or (isinstance(x, float) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-9))
                        for x, y in zip(a, b))
            n = sum(x != y for x, y in zip(got[1], want[1]))
            return f"{n} of {len(got[1])} rows differ{' (close)' if close else ''}: {a} / {b}"
    kinds = [(type(x).__name__, type(y).__name__, c) for a, b in zip(got[1], want[1]) for x, y, c in zip(a, b, got[0])
             if type(x) is not type(y)]
    return f"types {sorted(set(kinds))}" if kinds else None


def main() -> None:
    import __spark_entry__ as entry
    from tripstrata.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = get_session("compare", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            sql = entry.oracle_sql().get(name)
            problem = difference(df, con, sql) if sql else (None if df.collect() else "no rows")
            status = ("ok" if sql else "rows only") if problem is None else f"DIFF {problem}"
        except Exception as error:  # report and go on with the other queries
            status = "ERROR " + str(error).split("JVM stacktrace")[0][:700]
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.1f}s {status}", flush=True)
    print(f"{len(chosen)} queries, {bad} wrong")


if __name__ == "__main__":
    main()
