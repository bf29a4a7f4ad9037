"""Run registered queries beside their SQL and compare names, types and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads=8")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_value(v) for v in row) for row in zip(*columns))


def _kind(t):
    """Type as it matters to a reader: text variants and time units are one kind each."""
    s = str(t).replace("large_", "").replace("string_view", "string")
    return "timestamp" if s.startswith("timestamp") else "string" if s in ("utf8", "string") else s


def compare(spark, con, build, sql, sf_dir) -> list[str]:
    ours, theirs = build(spark, sf_dir).toArrow(), con.execute(sql).to_arrow_table()
    (n1, r1), (n2, r2) = _rows(ours), _rows(theirs)
    problems = []
    if n1 != n2:
        return [f"columns {n1} != {n2}"]
    for n in n1:
        a, b = _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} != {b}")
    if len(r1) != len(r2):
        problems.append(f"rows {len(r1)} != {len(r2)}")
    elif r1 != r2:
        bad = [(x, y) for x, y in zip(r1, r2) if x != y]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    if not r1:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as E
    from slotwise.session import get_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name, build in E.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            if name in E.ORACLES:
                out = compare(spark, con, build, E.ORACLES[name], sf)
            else:
                n = build(spark, sf).toArrow().num_rows
                out = [] if n else ["no rows"]
        except Exception as exc:  # noqa: BLE001
            out = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        failed += bool(out)
        kind = "sql " if name in E.ORACLES else "rows"
        print(f"{'FAIL' if out else 'ok  '} {kind} {time.time() - t:6.1f}s {name} {'; '.join(out)}", flush=True)
        spark.catalog.clearCache()
    print("failed", failed)
