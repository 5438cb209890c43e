"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import __spark_entry__ as E
    from fundlake.session import local_session
    spark = local_session(8, int(os.environ.get("CHECK_SHUFFLE", "8")))
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracle[name])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} ORACLE-ERROR {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(srows, scols)
        ho, lo = digest(orows, ocols)
        ok = (len(srows) == len(orows) and sorted(scols) == sorted(ocols) and hs == ho)
        print(f"{name:28s} {'OK ' if ok else 'MISMATCH'} rows={len(srows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(ocols):
                print("   cols spark:", sorted(scols), "\n   cols oracle:", sorted(ocols))
            else:
                only_s = sorted(set(ls) - set(lo))[:3]
                only_o = sorted(set(lo) - set(ls))[:3]
                print("   spark-only:", only_s, "\n   oracle-only:", only_o)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
