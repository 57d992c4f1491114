"""Runs registered queries next to their SQL on DuckDB and compares whole results.

    python tests/oracle.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
DATA = os.environ.get("VITALMART_DATA", "/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/sf{sf}/{t}.parquet')")
    return con


def cell(v):
    """Comparable (kind, value); floats must agree to the last digit after 12 significant ones."""
    if v is None:
        return ("null", "")
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("null", "") if math.isnan(v) else ("float", float(f"{v:.12g}"))
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (type(v).__name__, v.isoformat())
    return ("str", str(v))


def table_of(arrow) -> tuple[list[str], list[tuple]]:
    names = sorted(arrow.column_names)
    columns = [[cell(v) for v in arrow.column(c).to_pylist()] for c in names]
    return names, sorted(zip(*columns), key=repr) if columns else []


def compare(spark, con, name: str, fn, sql: str | None, sf: str) -> tuple[str, str]:
    got = fn(spark, f"{DATA}/sf{sf}").toArrow()
    if sql is None:
        return ("rows", f"{got.num_rows} rows")
    want = con.execute(sql).to_arrow_table()
    names_a, a = table_of(got)
    names_b, b = table_of(want)
    if names_a != names_b:
        return ("FAIL", f"columns differ: only spark {set(names_a) - set(names_b)}, only sql {set(names_b) - set(names_a)}")
    if len(a) != len(b):
        return ("FAIL", f"rows: spark {len(a)}, sql {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        cols = [(c, p, q) for c, p, q in zip(names_a, x, y) if p != q]
        return ("FAIL", f"{len(bad)} of {len(a)} rows differ, e.g. {cols[:4]}")
    if not a:
        return ("EMPTY", "no rows on either side")
    return ("ok", f"{len(a)} rows")


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from vitalmart.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("oracle-check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                       "spark.driver.memory": "8g",
                                                       "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = entry.oracle_sql()
    tally: dict[str, int] = {}
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            state, note = compare(spark, con, name, fn, oracles.get(name), sf)
        except Exception as e:  # the next query must still run
            state, note = "ERROR", f"{type(e).__name__}: {str(e).strip()[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        tally[state] = tally.get(state, 0) + 1
        print(f"{state:6} {time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(tally)
    return 1 if tally.get("FAIL") or tally.get("ERROR") else 0


if __name__ == "__main__":
    sys.exit(main())
