"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    if hasattr(v, "item"):
        return norm(v.item())
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(sdf, con, sql: str):
    """(ok, message) for a Spark DataFrame against DuckDB SQL."""
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    same_cols = sorted(scols) == sorted(dcols)
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    ok = same_cols and len(srows) == len(drows) and hs == hd
    msg = f"spark={len(srows)} duck={len(drows)} cols={'=' if same_cols else sorted(set(scols) ^ set(dcols))}"
    if not ok and same_cols:
        a, b = set(ls), set(ld)
        msg += "".join(f"\n   spark-only: {x[:300]}" for x in sorted(a - b)[:3])
        msg += "".join(f"\n   duck-only:  {x[:300]}" for x in sorted(b - a)[:3])
    return ok, msg
