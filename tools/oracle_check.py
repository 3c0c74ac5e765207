"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares row count, column names, and an order-insensitive hash of the values
(columns sorted by name, floats rounded to 9 places; STRICT=1 compares exact floats).
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from boxframe.plans.catalog import oracle_sql, queries  # noqa: E402
from boxframe.plans.fixtures import BASE_TABLES  # noqa: E402
from boxframe.session import local_session  # noqa: E402


STRICT = os.environ.get("STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(json.dumps({"query": name, "error": repr(e)[:400]}))
            bad += 1
            continue
        ts = time.time() - t0
        rec = {"query": name, "rows": len(rows), "spark_s": round(ts, 2)}
        if name in sqls:
            t0 = time.time()
            try:
                res = con.execute(sqls[name])
                ocols = [d[0] for d in res.description]
                orows = res.fetchall()
            except Exception as e:  # noqa: BLE001
                rec["oracle_error"] = repr(e)[:400]
                print(json.dumps(rec))
                bad += 1
                continue
            rec["duck_s"] = round(time.time() - t0, 2)
            h1, l1 = _digest(cols, rows)
            h2, l2 = _digest(ocols, orows)
            rec.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
                       hash_match=h1 == h2)
            if not (rec["cols_match"] and rec["hash_match"] and len(rows) == len(orows)):
                bad += 1
                rec["cols"] = sorted(cols)
                rec["ocols"] = sorted(ocols)
                d1 = sorted(set(l1) - set(l2))[:3]
                d2 = sorted(set(l2) - set(l1))[:3]
                rec["spark_only"] = d1
                rec["oracle_only"] = d2
        else:
            rec["oracle"] = "none"
        print(json.dumps(rec), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
