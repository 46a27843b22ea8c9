"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

from layerwright.sources import tickets as T


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in T.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 10**9 else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want = rows(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; spark only {sorted(a)[:2]}; sql only {sorted(b)[:2]} (columns {sorted(cols)})"
    types = {c: t for c, t in zip(cols, [str(d[1]) for d in cur.description], strict=True)}
    return None if got else f"empty result {types}"


def main(sf_dir, only):
    import __spark_entry__ as entry
    from layerwright import session
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con, sqls = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in sqls:
                error = compare(spark, con, name, query, sqls[name], sf_dir)
            else:
                n = query(spark, sf_dir).count()
                error = None if n else "no rows"
        except Exception as exc:  # noqa: BLE001
            error = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += error is not None
        print(f"{'ok ' if error is None else 'BAD'} {name:28s} {time.time() - t:6.2f}s {'' if name in sqls else '(no sql)'} {error or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
