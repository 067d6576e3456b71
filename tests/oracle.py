"""Compare a registered Spark job with its DuckDB oracle.

Row count, column names and an order-insensitive hash of the values, the
same three checks the driver records.  Usable from pytest and as a script:

    python -m tests.oracle /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)  # exact: the same double on both sides
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (_dt.datetime, _dt.date, _dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns: list[str], rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    hashes = sorted(hashlib.sha1("\x1f".join(canon(r[i]) for i in order).encode()).hexdigest()
                    for r in rows)
    return hashlib.sha1("".join(hashes).encode()).hexdigest()


def compare(spark, sf_dir: str, name: str, job, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = job(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "rows": len(rows), "spark_sec": round(time.time() - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    out.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
               hash_match=(sorted(cols) == sorted(ocols)) and digest(cols, rows) == digest(ocols, orows))
    out["status"] = "ok" if (out["hash_match"] and len(rows) == len(orows)) else "MISMATCH"
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(cols), sorted(ocols)
    elif out["status"] != "ok":
        out["diff"] = _diff(cols, rows, ocols, orows)
    return out


def _diff(cols, rows, ocols, orows, limit=3):
    idx = {c: i for i, c in enumerate(ocols)}
    a = {tuple(canon(r[i]) for i in range(len(cols))) for r in rows}
    b = {tuple(canon(r[idx[c]]) for c in cols) for r in orows}
    return {"spark_only": sorted(a - b)[:limit], "oracle_only": sorted(b - a)[:limit]}


def main(argv):
    sys.path.insert(0, ".")
    from sluice.session import local_session
    import __spark_entry__ as e
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    qs, oracles = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            res = compare(spark, sf_dir, name, qs[name], oracles.get(name), con)
        except Exception as exc:  # noqa: BLE001
            res = {"name": name, "status": "ERROR", "error": repr(exc)[:800]}
        bad += res["status"] in ("MISMATCH", "ERROR")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
