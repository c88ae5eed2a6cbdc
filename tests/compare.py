"""Compare registered queries with their SQL. Run: python tests/compare.py <sf_dir> [query ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = frame[c].dtype.kind
        if kind in "iub":
            frame[c] = frame[c].astype(float)
        elif kind == "O":
            values = pd.to_numeric(frame[c], errors="coerce") if frame[c].map(
                lambda v: v is None or isinstance(v, (int, float, bool, np.number))).all() else None
            frame[c] = values.astype(float) if values is not None else frame[c].map(
                lambda v: "<null>" if v is None or v is pd.NA else str(v))
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    a, b = _canonical(spark_rows), _canonical(sql_rows)
    for c in a.columns:
        if a[c].dtype.kind != b[c].dtype.kind:
            return f"{c}: types {spark_rows[c].dtype} / {sql_rows[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} values differ, first {a.loc[at].to_dict()} / {b.loc[at].to_dict()}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("compare").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, db = session(), connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        started = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            spent = time.time() - started
            if name in checks:
                started = time.time()
                want = db.execute(checks[name]).df()
                verdict = differences(got, want) or f"ok (sql {time.time() - started:.1f}s)"
            else:
                verdict = "rows only"
            failed += not verdict.startswith(("ok", "rows only"))
            print(f"{name:28s} {len(got):8d} rows {spent:6.1f}s  {verdict}", flush=True)
        except Exception as error:  # noqa: BLE001 - report and go on
            failed += 1
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
