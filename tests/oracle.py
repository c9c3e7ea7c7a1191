"""Run registered queries against DuckDB on the same files; also usable as a script."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, dict)):
        return repr(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def main() -> int:
    import __spark_entry__ as entry

    from tradewatch.session import local_session

    sf_dir = sys.argv[1]
    wanted = set(sys.argv[2:])
    spark, con, bad = local_session(8), connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            columns, got = spark_rows(query(spark, sf_dir))
            spent = time.time() - start
            if name not in oracles:
                print(f"ROWS {name} {len(got)} {spent:.1f}s e.g. {got[:1]!r:.300}", flush=True)
                continue
            names, want = duck_rows(con, oracles[name])
        except Exception as error:
            bad += 1
            print(f"FAIL {name} {type(error).__name__} {str(error)[:1500]}", flush=True)
            continue
        if (columns, got) == (names, want):
            print(f"ok   {name} {len(got)} {spent:.1f}s", flush=True)
        else:
            bad += 1
            print(f"DIFF {name} {len(got)} vs {len(want)}", columns if columns != names else "", names if columns != names else "")
            extra, missing = set(got) - set(want), set(want) - set(got)
            print("  only spark", len(extra), sorted(extra, key=repr)[:3])
            print("  only duck ", len(missing), sorted(missing, key=repr)[:3], flush=True)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(main())
