"""Run registered queries next to their SQL twins and compare values.

``python tests/oracle_check.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool):
        return str(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    names, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None, f"{len(got)} rows, no twin"
    rel = con.execute(sql)
    want_names, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if names != want_names:
        return False, f"columns {names} != {want_names}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return not bad, f"{len(got)} rows" + (f", {len(bad)} differ: {bad[:2]}" if bad else "")


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from postsieve import build_session

    sf = argv[0] if argv else "0.001"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, twins = duck(sf_dir), oracle_sql()
    failed = []
    for name, fn in queries().items():
        if argv[1:] and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in argv[1:]):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, fn, twins.get(name))
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok ' if ok else '-- ' if ok is None else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if ok is False:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
