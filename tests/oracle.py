"""Runs a registered query and its SQL twin on the same parquet files and compares rows."""
from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(plain(r[i]) for i in order) for r in cur.fetchall())


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def duck_types(con, sql):
    cur = con.execute(sql)
    return {d[0]: str(d[1]) for d in cur.description}


def compare(con, df, sql):
    """Empty string when equal, otherwise what differs."""
    got_names, got = spark_rows(df)
    if not got:
        return "EMPTY"
    want_names, want = duck_rows(con, sql)
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got != want:
        extra, missing = list((got - want).elements()), list((want - got).elements())
        return (f"{sum(got.values())} vs {sum(want.values())} rows; {len(extra)} extra "
                f"{sorted(extra, key=str)[:3]}; {len(missing)} missing "
                f"{sorted(missing, key=str)[:3]} cols {got_names}")
    types = {d[0]: str(d[1]) for d in con.execute(sql).description}
    odd = {c: (t, types[c]) for c, t in df.dtypes
           if KINDS.get(types[c], types[c]) != t}
    return f"types {odd}" if odd else ""


def main():
    from tests.session import local_session
    from tidemark.plans.catalogue import ORACLES, QUERIES

    sf_dir = sys.argv[1]
    picks = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                problem = compare(con, df, ORACLES[name])
                kind = "sql"
            else:
                n = df.count()
                kind, problem = f"rows={n}", "" if n else "EMPTY"
        except Exception as exc:  # noqa: BLE001
            kind, problem = "error", f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name} {kind} {time.time() - start:.2f}s "
              f"{problem}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
