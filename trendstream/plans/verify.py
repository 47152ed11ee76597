"""Compare a query result with its SQL oracle run by DuckDB (tests and scripts)."""

from __future__ import annotations

import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def canonical(names, rows):
    """Rows with columns sorted by name, values normalised, rows sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str):
    """(ok, message) for a Spark DataFrame against an oracle SQL string."""
    srows, snames = df.collect(), df.columns
    cur = con.execute(sql)
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    if sorted(snames) != sorted(dnames):
        return False, f"columns {sorted(snames)} vs {sorted(dnames)}"
    a, b = canonical(snames, srows), canonical(dnames, drows)
    if a == b:
        return True, f"{len(a)} rows"
    sa, sb = set(a), set(b)
    return False, (f"{len(a)} vs {len(b)} rows; spark-only {list(sa - sb)[:2]}; "
                   f"oracle-only {list(sb - sa)[:2]}")
