"""Run registered queries and their SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}; spark {got[1][:2]} sql {want[1][:2]}"
    for g, w in zip(got[1], want[1]):
        kinds = [(type(a).__name__, type(b).__name__) for a, b in zip(g, w) if None not in (a, b) and type(a) is not type(b)]
        if kinds:
            return f"types differ {kinds} in {g!r:.300}"
        if g != w:
            return f"row {g!r:.600}\n   != {w!r:.600}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from qaloom.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, sf_dir))
            took = time.time() - start
            start = time.time()
            problem = difference(got, sql_rows(con, oracles[name])) if name in oracles else None
            note = "" if name in oracles else " (no SQL)"
            print(f"{'FAIL' if problem else 'ok  '} {name}{note} rows={len(got[1])} spark={took:.1f}s sql={time.time() - start:.1f}s", flush=True)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
            print(f"FAIL {name}", flush=True)
        if problem:
            bad += 1
            print("  ", problem, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
