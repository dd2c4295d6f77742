"""Run a registered Spark plan and its DuckDB twin on the same parquet tables and compare."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, queries: dict, sqls: dict, con=None, show: int = 3):
    sdf = queries[name](spark, sf_dir)
    sp = sdf.toPandas()
    con = con or duck(sf_dir)
    dp = con.execute(sqls[name]).df()
    sc, sr = rows(sp)
    dc, dr = rows(dp)
    ok = sc == dc and len(sr) == len(dr) and sr == dr
    msg = f"{name}: spark={len(sr)} duck={len(dr)} cols_equal={sc == dc}"
    if not ok:
        if sc != dc:
            msg += f"\n  spark cols {sc}\n  duck  cols {dc}"
        else:
            diff_s = [r for r in sr if r not in set(dr)][:show]
            diff_d = [r for r in dr if r not in set(sr)][:show]
            msg += f"\n  only spark: {diff_s}\n  only duck:  {diff_d}"
    return ok, msg


if __name__ == "__main__":
    import time

    import __spark_entry__ as E
    from thawline.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", os.environ.get("PLAIN_TZ", "America/Los_Angeles"))
                 .getOrCreate())
    else:
        spark = local_session()
    qs, sq = E.queries(), E.oracle_sql()
    con = duck(sf)
    names = names or sorted(sq)
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, n, sf, qs, sq, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("\n" + ("OK  " if ok else "BAD ") + msg + f"  ({time.time() - t:.1f}s)", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
