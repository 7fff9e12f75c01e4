"""Compare registered queries with their SQL oracles in DuckDB.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, bool):
        return v
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def differences(ours, theirs, limit=3):
    """Texts describing where two (columns, rows) results differ."""
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    out = []
    if len(ours[1]) != len(theirs[1]):
        out.append(f"rows {len(ours[1])} != {len(theirs[1])}")
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append("; ".join(f"{c}: {x!r} != {y!r}" for c, x, y in zip(ours[0], a, b) if x != y or type(x) is not type(y))[:600])
            if len(out) >= limit:
                break
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from voltide.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("MANY_CHUNKS"):  # small range partitions stay apart
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    con = duck(sf_dir)
    fns, sqls = queries(), oracle_sql()
    bad = []
    for name in wanted or fns:
        start = time.time()
        try:
            ours = spark_rows(fns[name](spark, sf_dir))
            took = time.time() - start
            if name in sqls:
                diff = differences(ours, duck_rows(con, sqls[name]))
                state = "ok" if not diff else "DIFF"
            else:
                diff, state = [], "rows"
            print(f"{state:5} {name:32} {len(ours[1]):8} rows {took:6.2f}s", flush=True)
            for line in diff:
                print("      ", line, flush=True)
            if diff:
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: {type(e).__name__}: {str(e)[:700]}", flush=True)
            bad.append(name)
    print(f"{len(wanted or fns)} queries, {len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
