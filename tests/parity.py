"""Compare registered queries with their SQL twins on the driver's tables."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(v) if v == v else "nan"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """None when equal, else what differs."""
    got = query(spark, folder)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    if sql is None:
        return None if mine else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} vs {sorted(names)}"
    if len(mine) != len(want):
        return f"rows {len(mine)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(mine, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(folder: str, only: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from recordlake.session import build_session

    spark = build_session("parity", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = duck(folder)
    sql, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, query, sql.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        mark = "ok " if problem is None else "BAD"
        failed += problem is not None
        print(f"{mark} {name:32s} {time.time() - start:6.2f}s {'' if sql.get(name) else '(rows) '}{problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
