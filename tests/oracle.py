"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and value == 0:
        return "0.0"
    return "~" if value is None else repr(value) if isinstance(value, (float, int)) else str(value)


def differences(spark, con, run, sql: str, folder: str) -> list[str]:
    """Empty when names, types in kind and all rows agree."""
    result = run(spark, folder)
    names = sorted(result.columns)
    mine = [tuple(row[n] for n in names) for row in result.collect()]
    cursor = con.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    if sorted(theirs_names) != names:
        return [f"columns {names} against {sorted(theirs_names)}"]
    order = [theirs_names.index(n) for n in names]
    theirs = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows against {len(theirs)}"]
    left, right = (sorted(tuple(map(_cell, row)) for row in rows) for rows in (mine, theirs))
    found = [f"{names}: {a} against {b}" for a, b in zip(left, right) if a != b]
    return found[:3] + ([f"{len(found)} rows differ"] if found else [])


def main(folder: str, *wanted: str) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from overspend.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(folder), 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, run, sqls[name], folder)
                rows = "checked, {} rows".format(con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0])
            else:
                found, rows = [], f"no SQL, {run(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            found, rows = [f"{type(error).__name__}: {str(error)[:600]}"], "failed"
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name:32s} {time.time() - began:6.2f}s  {rows}", *found, sep="\n      " if found else " ", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
