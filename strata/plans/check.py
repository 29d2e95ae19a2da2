"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's comparison: same column names, same row count, and the
same multiset of rows (order-insensitive; doubles compared after rounding).
"""

from __future__ import annotations

import math
from collections import Counter

from ..sources.tables import TABLES


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def compare(spark_rows, spark_cols, oracle_rows, oracle_cols, digits=6):
    problems = []
    if sorted(spark_cols) != sorted(oracle_cols):
        problems.append(f"columns differ: spark-only={sorted(set(spark_cols)-set(oracle_cols))} "
                        f"oracle-only={sorted(set(oracle_cols)-set(spark_cols))}")
        return problems
    if len(spark_rows) != len(oracle_rows):
        problems.append(f"row count spark={len(spark_rows)} oracle={len(oracle_rows)}")
    names = sorted(spark_cols)
    si = [spark_cols.index(n) for n in names]
    oi = [oracle_cols.index(n) for n in names]
    a = Counter(tuple(_norm(r[i], digits) for i in si) for r in spark_rows)
    b = Counter(tuple(_norm(r[i], digits) for i in oi) for r in oracle_rows)
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        problems.append(f"values differ: spark-only={only_a} oracle-only={only_b} (cols {names})")
    return problems


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT",
                  "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_problems(df, res) -> list[str]:
    """Column types that would differ between the two results."""
    duck = {d[0]: str(d[1]).upper() for d in res.description}
    out = []
    for f in df.schema.fields:
        st = f.dataType.simpleString()
        want = _SPARK_TO_DUCK.get(st, st.upper())
        got = duck.get(f.name)
        if got is not None and got != want:
            out.append(f"{f.name}: spark {st} vs oracle {got}")
    return out


def check_query(spark, q, sf_dir: str, con=None):
    con = con or duckdb_conn(sf_dir)
    df = q.run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    if q.sql is None:
        return {"name": q.name, "rows": len(rows), "oracle": None, "problems": []}
    res = con.execute(q.sql)
    ocols = [d[0] for d in res.description]
    types = type_problems(df, res)
    orows = res.fetchall()
    probs = compare(rows, cols, orows, ocols)
    if types:
        probs.append("types differ: " + "; ".join(types))
    return {"name": q.name, "rows": len(rows), "oracle_rows": len(orows), "problems": probs}
