"""Compare registered queries against their DuckDB oracle (the driver's check, locally).

    python -m quarry.verify [--sf /root/testdata/sf0.01] [NAME_PREFIX ...]

Checks column names, type families, row count and the order-insensitive
multiset of values (floats compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from quarry.sources.tables import TABLES

_TYPE_MAP = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}


def spark_type_to_duck(t: str) -> str:
    if t.startswith("array<") and t.endswith(">"):
        return spark_type_to_duck(t[6:-1]) + "[]"
    return _TYPE_MAP.get(t, t.upper())


def duck_con(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (np.floating,)):
        return _norm(float(v))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if v is pd.NaT:
        return None
    return v


def _rows(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple, np.ndarray, dict)) and pd.isna(x)) else x)
                         for x in rec))
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from quarry.plans.registry import load_all

    spec = load_all()[name]
    t0 = time.time()
    sdf = spec.build(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_pdf = sdf.toPandas()
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(s_pdf), "spark_sec": round(t_spark, 2)}
    if spec.oracle is None:
        res["status"] = "rows-only"
        return res
    con = con or duck_con(sf_dir)
    rel = con.execute(spec.oracle)
    d_cols = [d[0] for d in rel.description]
    d_pdf = rel.fetchdf()
    d_types = {c: str(x[1]) for c, x in zip(d_cols, rel.description)}
    problems = []
    if sorted(s_pdf.columns) != sorted(d_pdf.columns):
        problems.append(f"columns spark={sorted(s_pdf.columns)} oracle={sorted(d_pdf.columns)}")
    if len(s_pdf) != len(d_pdf):
        problems.append(f"rows spark={len(s_pdf)} oracle={len(d_pdf)}")
    if not problems:
        a, b = _rows(s_pdf), _rows(d_pdf)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    s_duck = {k: spark_type_to_duck(v) for k, v in s_types.items()}
    tdiff = {k: (s_duck[k], d_types[k]) for k in s_duck if k in d_types and s_duck[k] != d_types[k]}
    if tdiff:
        problems.append(f"types {tdiff}")
    res["status"] = "ok" if not problems else "FAIL"
    res["problems"] = problems
    return res


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    from quarry.plans.registry import load_all
    from quarry.session import build_session

    spark = build_session()
    con = duck_con(args.sf)
    names = [n for n in sorted(load_all()) if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, args.sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "ERROR", "problems": [f"{type(e).__name__}: {str(e)[:400]}"]}
        if r["status"] in ("FAIL", "ERROR"):
            bad += 1
        print(f"{r['status']:9} {n:40} rows={r.get('rows')} t={r.get('spark_sec')} {'; '.join(r.get('problems', []))}",
              flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
