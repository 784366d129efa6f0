"""Run registered queries in Spark and in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, (float, Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else format(float(v), ".9g")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str):
    """(equal, Spark rows, DuckDB rows, first differences)."""
    df = query(spark, sf_dir)
    cols, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    theirs_cols, theirs = rows_of(result.columns, result.fetchall())
    if cols != theirs_cols:
        return False, len(mine), len(theirs), [cols, theirs_cols]
    differing = [pair for pair in zip(mine, theirs) if pair[0] != pair[1]][:2]
    return mine == theirs, len(mine), len(theirs), differing


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con = make_session(), duck(sf_dir)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in sqls or (names and name not in names):
            continue
        start = time.time()
        try:
            equal, mine, theirs, diff = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as e:  # noqa: BLE001 - a report line per query
            equal, mine, theirs, diff = False, -1, -1, str(e)[:1500]
        print("OK  " if equal else "DIFF", name, mine, theirs, f"{time.time() - start:.1f}s", "" if equal else diff, flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
