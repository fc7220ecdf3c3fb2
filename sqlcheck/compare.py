"""Order-insensitive, exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(scols, srows, dcols, drows) -> str | None:
    """None when equal, else a short description of the first difference."""
    if sorted(scols) != sorted(dcols):
        return f"columns {scols} vs {dcols}"
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    s2 = sorted((tuple(norm(r[i]) for i in order) for r in srows), key=_key)
    d2 = sorted((tuple(norm(r[i]) for i in dorder) for r in drows), key=_key)
    if s2 != d2:
        diff = [(x, y) for x, y in zip(s2, d2) if x != y][:3]
        return f"rows {len(s2)} vs {len(d2)}; first diffs {diff}"
    return None
