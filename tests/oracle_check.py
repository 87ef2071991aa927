"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql):
    """(matches, text) for one query."""
    got, got_columns = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want, want_columns = bag([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return False, (
            f"rows {got.total()} vs {want.total()}; only Spark {extra.total()} {list(extra)[:2]}; "
            f"only SQL {missing.total()} {list(missing)[:2]}"
        )
    return True, f"{got.total()} rows"


def main():
    from clickloom.session import get_spark
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                ok, text = compare(df, con, sqls[name])
            else:
                ok, text = True, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            ok, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {text}", flush=True)
    print("failed:", bad)
    spark.stop()
    os._exit(1 if bad else 0)


if __name__ == "__main__":
    main()
