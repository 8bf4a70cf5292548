"""Compare queries with their SQL in DuckDB: `python -m tests.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("time", str(v))
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    return ("other", str(v)) if v is not None else ("null", "")


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return normal(rel.columns, rel.fetchall())


def difference(got, expected):
    """None if equal, else what differs first."""
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if got[1] == expected[1]:
        return None
    extra, lacking = sorted(set(got[1]) - set(expected[1]))[:2], sorted(set(expected[1]) - set(got[1]))[:2]
    return f"{len(got[1])} rows, expected {len(expected[1])}; extra {extra}; lacking {lacking}"


def main() -> int:
    from millrace.session import build_session

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        begun = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            took = time.time() - begun
            wrong = difference(got, duck_rows(con, sql[name])) if name in sql else None
            outcome = "ok" if name in sql else "rows only"
            if wrong is None and not got[1]:
                wrong = "no rows"
        except Exception as e:  # report and go on with the next query
            took, wrong = time.time() - begun, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += wrong is not None
        print(f"{name:28s} {took:6.2f}s {len(got[1]) if wrong is None else '':>7} {outcome if wrong is None else 'WRONG ' + wrong}", flush=True)
    print("failed:", failed)
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main())
