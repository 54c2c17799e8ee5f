"""Run registered Spark queries beside their DuckDB oracle SQL and compare
row count, column names and values (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v.hex()          # exact: money is summed as DECIMAL on both sides
    if v is pd.NaT:
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return out


def compare(spark, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    dt_spark = time.time() - t
    res = {"query": name, "rows": len(spdf), "spark_sec": round(dt_spark, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    odf = duck(sf_dir).execute(sql).df()
    res["oracle_rows"] = len(odf)
    res["cols_match"] = sorted(spdf.columns) == sorted(odf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(spdf.columns)
        res["oracle_cols"] = sorted(odf.columns)
        res["match"] = False
        return res
    a, b = _rows(spdf), _rows(odf)
    res["match"] = a == b
    if not res["match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["only_spark"] = diff_a
        res["only_oracle"] = diff_b
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from starmart.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name))
        except Exception as ex:  # report and continue
            r = {"query": name, "error": repr(ex)[:600]}
        ok = r.get("match", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
