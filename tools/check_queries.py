"""Run every registered query next to its SQL in DuckDB and compare the rows.

    python tools/check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabkit.plans import ORACLES, QUERIES  # noqa: E402
from tabkit.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(rows, names) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, folder: str, name: str) -> str:
    df = QUERIES[name](spark, folder)
    names = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return f"rows only ({len(rows)})" if rows else "NO ROWS"
    result = con.execute(ORACLES[name])
    sql_names = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    if sorted(names) != sorted(sql_names):
        return f"COLUMNS {sorted(names)} <> {sorted(sql_names)}"
    mine, theirs = canonical(rows, names), canonical(sql_rows, sql_names)
    if mine != theirs:
        left = [r for r in mine if r not in set(theirs)][:3]
        right = [r for r in theirs if r not in set(mine)][:3]
        return f"VALUES {len(mine)} <> {len(theirs)}\n    spark {left}\n    sql   {right}"
    types = dict(zip(sql_names, [str(d[1]) for d in result.description]))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = {f"{kinds[n]}~{types[n]}" for n in names}
    return f"ok ({len(rows)}) {sorted(pairs)}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", 8, 8, log_level="ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.perf_counter()
        try:
            verdict = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001  (reported per query)
            lines = [x for x in traceback.format_exc().splitlines() if x.strip()]
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]} @ {lines[-6:-3]}"
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{time.perf_counter() - start:6.2f}s {name}: {verdict}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
