"""Run each job in Spark and its oracle SQL in DuckDB; compare the results.

    python tools/check_oracle.py [--sf-dir DIR] [job ...]

Reports per job: row counts, column names, Spark vs DuckDB column types, and
whether the values agree exactly (``exact``) or only within 1e-9 relative
(``close``).  Column order does not matter; rows are compared as multisets.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidewater.plans.catalog import load_all  # noqa: E402
from tidewater.session import local_session  # noqa: E402
from tidewater.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "date": "DATE",
}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: repr(t))


def _close(a, b):
    if isinstance(a, float) and isinstance(b, (float, int)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == b


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("jobs", nargs="*")
    args = ap.parse_args()

    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf_dir}/{t}.parquet')")

    jobs = load_all()
    names = args.jobs or sorted(jobs)
    bad = 0
    for name in names:
        j = jobs[name]
        t0 = time.time()
        try:
            sdf = j.build(spark, args.sf_dir)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not j.oracle:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {dt:6.1f}s")
            continue
        try:
            rel = con.execute(j.oracle)
            dcols = [d[0] for d in rel.description]
            dtypes = {d[0]: str(d[1]) for d in rel.description}
            drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        scols = sorted(stypes)
        if scols != sorted(dcols):
            print(f"{name:32s} COLUMNS differ spark={scols} duck={sorted(dcols)}")
            bad += 1
            continue
        type_diff = {
            c: (stypes[c], dtypes[c])
            for c in scols
            if SPARK_TO_DUCK.get(stypes[c], stypes[c].upper()) != dtypes[c]
        }
        a, b = _rows(srows, scols), _rows(drows, scols)
        if len(a) != len(b):
            verdict = f"ROWCOUNT spark={len(a)} duck={len(b)}"
        elif a == b:
            verdict = "exact"
        elif all(_close(x, y) for x, y in zip(a, b)):
            verdict = "close"
        else:
            diffs = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
            verdict = f"VALUES differ in {len(diffs)} rows, e.g. {diffs[0]}"
        ok = verdict == "exact" and not type_diff
        bad += 0 if ok else 1
        td = f" types={type_diff}" if type_diff else ""
        print(f"{name:32s} rows={len(a):7d} {verdict}{td} {dt:6.1f}s")
    print(f"{len(names) - bad}/{len(names)} clean")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
