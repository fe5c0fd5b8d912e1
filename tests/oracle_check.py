"""Run registered queries on Spark and their oracle SQL on DuckDB; compare the results.

Comparison mirrors the driver: column names sorted, row multiset compared.  ``exact`` compares
values as produced (floats bit for bit); ``close`` rounds floats to 9 significant digits.

    python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (np.floating,)):
        v = float(v)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x, digits) for x in v)
    return v


def _kind(dtype_val) -> str:
    if dtype_val is None:
        return "null"
    if isinstance(dtype_val, bool):
        return "bool"
    if isinstance(dtype_val, int):
        return "int"
    if isinstance(dtype_val, float):
        return "float"
    if isinstance(dtype_val, str):
        return "str"
    return type(dtype_val).__name__


def rows_of(pdf: pd.DataFrame, digits):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return cols, out


def _sortkey(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"rows_spark": len(spark_pdf), "rows_oracle": len(duck_pdf)}
    sc, sd = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    res["columns_match"] = sc == sd
    if sc != sd:
        res["cols_spark"], res["cols_oracle"] = sc, sd
        return res
    for label, digits in (("exact", None), ("close", 9)):
        _, a = rows_of(spark_pdf, digits)
        _, b = rows_of(duck_pdf, digits)
        res[label] = sorted(a, key=_sortkey) == sorted(b, key=_sortkey)
        if label == "close" and not res[label]:
            sa, sb = sorted(a, key=_sortkey), sorted(b, key=_sortkey)
            diff = [(x, y) for x, y in zip(sa, sb) if x != y][:3]
            res["first_diffs"] = diff
    # kinds per column (first non-null value)
    kinds = {}
    for c in sc:
        ks = next((_kind(_norm(v, None)) for v in spark_pdf[c] if _norm(v, None) is not None), "null")
        kd = next((_kind(_norm(v, None)) for v in duck_pdf[c] if _norm(v, None) is not None), "null")
        if ks != kd:
            kinds[c] = (ks, kd)
    res["kind_mismatch"] = kinds
    res["dtype_mismatch"] = {c: (str(spark_pdf[c].dtype), str(duck_pdf[c].dtype)) for c in sc
                             if str(spark_pdf[c].dtype) != str(duck_pdf[c].dtype)}
    return res


def run(spark, sf_dir: str, names=None, verbose=True) -> dict:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            spdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = {"error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            if verbose:
                print(name, out[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            out[name] = {"rows_spark": len(spdf), "sql": False, "sec": round(ts, 2)}
        else:
            try:
                dpdf = con.sql(sqls[name]).to_arrow_table().to_pandas(date_as_object=True)
                r = compare(spdf, dpdf)
            except Exception as e:  # noqa: BLE001
                r = {"error": f"duckdb: {type(e).__name__}: {str(e)[:400]}"}
            r["sec"] = round(ts, 2)
            out[name] = r
        if verbose:
            print(name, out[name], flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from sparkmart.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    res = run(spark, sf, names)
    bad = [n for n, r in res.items() if "error" in r or (r.get("sql", True) and not r.get("exact"))]
    print("SUMMARY", len(res), "queries;", "not exact:", bad)
