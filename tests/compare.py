"""Run registered queries against their SQL twins: python tests/compare.py SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return str(value)


def difference(df, con, sql: str) -> str | None:
    """None when rows, names, and values agree; else what differs."""
    result = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(result.columns):
        return f"columns {names} != {sorted(result.columns)}"
    mine = sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())
    theirs_rows, order = result.fetchall(), [result.columns.index(n) for n in names]
    theirs = sorted(tuple(_plain(row[i]) for i in order) for row in theirs_rows)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {names}: {bad[0]}"
    return None


def main() -> None:
    from rideflow.session import build_session

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, oracle[name]) if name in oracle else None
            note = "" if name in oracle else f" (no SQL, {df.count()} rows)"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - started:6.1f}s {name}{note} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
