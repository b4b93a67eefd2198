"""Run registered queries in Spark and their oracle SQL in DuckDB, and
compare row count, column names and order-insensitive values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not hasattr(v, "year"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    return repr(v)


def _missing(x) -> bool:
    """Null in any pandas spelling. Float NaN is kept as a value: pandas
    also writes null doubles as NaN, on both sides alike."""
    if x is None or x is pd.NaT:
        return True
    if isinstance(x, (float, str, bytes, list, tuple)):
        return False
    try:
        return bool(pd.isna(x))
    except (TypeError, ValueError):
        return False


def rows_of(df: pd.DataFrame) -> list[tuple]:
    """Rows as tuples of normalised values, columns by name, rows sorted."""
    cols = sorted(df.columns)
    out = [tuple(None if _missing(x) else _norm(x) for x in rec)
           for rec in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            pdf = sdf.toPandas()
            for f in sdf.schema.fields:  # pandas writes whole numbers with nulls as floats
                if f.dataType.typeName() in ("byte", "short", "integer", "long"):
                    pdf[f.name] = pdf[f.name].astype("Int64")
        except Exception as e:  # noqa: BLE001
            report[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, report[name]); continue
        if name not in sqls:
            report[name] = f"rows-only {len(pdf)}"
            print(f"{name}: rows-only {len(pdf)} ({time.time()-t0:.1f}s)"); continue
        try:
            ddf = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            report[name] = f"DUCK ERROR {e}"
            print(name, report[name][:500]); continue
        ok_cols = sorted(pdf.columns) == sorted(ddf.columns)
        ok_n = len(pdf) == len(ddf)
        ok_v = ok_cols and ok_n and rows_of(pdf) == rows_of(ddf)
        report[name] = "OK" if ok_v else f"MISMATCH cols={ok_cols} n={len(pdf)}/{len(ddf)}"
        print(f"{name}: {report[name]} ({time.time()-t0:.1f}s)")
        if not ok_v and verbose:
            if not ok_cols:
                print("  spark:", sorted(pdf.columns), "\n  duck: ", sorted(ddf.columns))
            else:
                a, b = rows_of(pdf), rows_of(ddf)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("  cols:", sorted(pdf.columns))
                print("  spark-only:", diff_a)
                print("  duck-only: ", diff_b)
    return report


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    rep = compare(spark, sf, names)
    bad = {k: v for k, v in rep.items() if v != "OK" and not v.startswith("rows-only")}
    print("SUMMARY:", len(rep) - len(bad), "ok/rows-only of", len(rep), "bad:", list(bad))
