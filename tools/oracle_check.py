"""Local stand-in for the driver's correctness gate.

Runs each registered analysis in Spark and its SQL in DuckDB on the same
parquet directory and compares column names, row counts and sorted values.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from tidemark.registry import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402
from tidemark.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("n", round(v, 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v))
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return ("t", s.replace("T", " "))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return ("s", str(v))


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _same_type(s, d):
    return _TYPES.get(s, s) == d


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    names = a.names or sorted(reg)
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for n in names:
        an = reg[n]
        t0 = time.time()
        try:
            df = an.build(spark, a.sf)
            scols = df.columns
            sdt = dict(df.dtypes)
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if an.sql is None:
            print(f"ROWS {n}: {len(srows)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            res = con.execute(an.sql)
            dcols = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {n}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        if len(srows) != len(drows):
            print(f"FAIL {n}: rows spark={len(srows)} duck={len(drows)}")
            bad += 1
            continue
        sr, dr = _rows(scols, srows), _rows(dcols, drows)
        if sr != dr:
            diff = next(i for i in range(len(sr)) if sr[i] != dr[i])
            print(f"FAIL {n}: values differ at sorted row {diff}\n  spark={sr[diff]}\n  duck ={dr[diff]}")
            bad += 1
            continue
        tdiff = {c: (sdt[c], dtypes[c]) for c in scols if not _same_type(sdt[c], dtypes[c])}
        print(f"OK   {n}: {len(srows)} rows ({ts:.1f}s)" + (f" TYPE-DIFF {tdiff}" if tdiff else ""))
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
