"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/compare.py [sf_dir] [name ...]
Prints one line per query: OK / DIFF / SPARK-ONLY with row counts.
"""

from __future__ import annotations

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
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return bool(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    from newsloom import registry
    qs = registry.queries()
    sqls = registry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SPARK-ERROR {results[name][1]}", flush=True)
            continue
        dt = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS", len(srows))
            if verbose:
                print(f"{name:32s} ROWS-ONLY spark={len(srows)} {dt:.2f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:
            results[name] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SQL-ERROR {results[name][1]}", flush=True)
            continue
        sn, sr = canon(cols, srows)
        dn, dr = canon(dcols, drows)
        ok = sn == dn and sr == dr
        results[name] = ("OK" if ok else "DIFF", len(srows), len(drows))
        if verbose:
            msg = f"{name:32s} {'OK  ' if ok else 'DIFF'} spark={len(srows)} duck={len(drows)} {dt:.2f}s"
            if not ok:
                if sn != dn:
                    msg += f" cols {sn} vs {dn}"
                else:
                    a, b = set(map(repr, sr)), set(map(repr, dr))
                    only_s = sorted(a - b)[:2]
                    only_d = sorted(b - a)[:2]
                    msg += f"\n   spark-only {[s[:300] for s in only_s]}\n   duck-only  {[s[:300] for s in only_d]}"
            print(msg, flush=True)
    return results


if __name__ == "__main__":
    from newsloom.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": "8g"})
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS")]
    print(f"\n{len(res) - len(bad)}/{len(res)} good; bad: {bad}")
