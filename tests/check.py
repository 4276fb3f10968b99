"""Compare registered queries with their SQL on DuckDB.

    python tests/check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else what is different."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            types = [type(x).__name__ for x in a]
            return f"first difference in {sorted(names)}:\n  spark  {a}\n  duckdb {b}\n  {types}"
    return None


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from churnloom.session import build

    sf_dir, *names = sys.argv[1:]
    spark = build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in sql:
                found = difference(run(spark, sf_dir), con, sql[name])
                n = ""
            else:
                n, found = f"{run(spark, sf_dir).count()} rows", None
        except Exception as error:  # noqa: BLE001 - report every query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{name:26s} {time.time() - started:6.1f}s {found or 'ok'} {n}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
