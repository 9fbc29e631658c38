"""Runs registered queries beside their SQL in DuckDB and compares the results value by value.

Usage: python tests/compare.py [folder] [query ids or module prefixes ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return "<null>"
    if isinstance(value, float) and math.isnan(value):
        return "<nan>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat().replace("T00:00:00", "")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, run, sql, folder) -> str | None:
    df = run(spark, folder)
    got = df.collect()
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    families = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    odd = [(n, t, kinds[n]) for n, t in df.dtypes if families.get(t, "?") != kinds[n]]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"rows {len(a)} vs {len(b)}; only spark {only_a}; only sql {only_b}"
    return f"types differ: {odd}" if odd else ("both empty" if not a else None)


def main() -> int:
    from kpiloom import catalog  # noqa: F401
    from kpiloom.session import build_session
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.ui.explainMode", "simple")
    con, bad = database(folder), 0
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name, run in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            result = differences(spark, con, run, sqls[name], folder) if name in sqls else f"rows only: {run(spark, folder).count()}"
        except Exception as error:
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += result is not None and not result.startswith("rows only")
        print(f"{name:8s} {time.time() - started:6.2f}s {'ok' if result is None else result}", flush=True)
    print(f"{bad} of {len(queries)} differ")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
