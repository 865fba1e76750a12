"""Compare every registered query with its DuckDB SQL on one scale factor.

    python tests/oracle_check.py [/root/testdata/sf0.01] [name ...]

Rows are compared as multisets after normalising values (decimals and
floats to text with fixed rounding); column names must match exactly.
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def duck_rows(sf_dir: str, sql: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    out = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        d_cols, d_rows = duck_rows(sf_dir, sqls[name])
        ok_cols = sorted(s_cols) == sorted(d_cols)
        res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "cols_match": ok_cols,
               "spark_sec": round(t1 - t0, 2)}
        if ok_cols:
            order = [d_cols.index(c) for c in s_cols]
            sc = Counter(tuple(_norm(v) for v in r) for r in s_rows)
            dc = Counter(tuple(_norm(r[i]) for i in order) for r in d_rows)
            res["values_match"] = sc == dc
            if sc != dc and verbose:
                res["only_spark"] = list((sc - dc).items())[:3]
                res["only_oracle"] = list((dc - sc).items())[:3]
        else:
            res["values_match"] = False
            res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from tidemark.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if not (r["cols_match"] and r["values_match"]
                                             and r["spark_rows"] == r["oracle_rows"])]
    print("MISMATCH:", bad if bad else "none")
