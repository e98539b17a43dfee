"""Compare a Spark query with its DuckDB oracle: row count, columns, value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from corridor.plans.views import BASE_TABLES


def norm(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


# Common names for the column types both engines produce.
_SPARK_TYPES = {"LongType": "int64", "IntegerType": "int32", "DoubleType": "float64", "StringType": "string",
                "BooleanType": "bool", "TimestampNTZType": "timestamp", "TimestampType": "timestamp",
                "DateType": "date"}
_DUCK_TYPES = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "string",
               "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date"}


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    cols = df.columns
    stypes = {f.name: _SPARK_TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__)
              for f in df.schema.fields}
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    dtypes = {c: _DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    h1, l1 = digest(cols, rows)
    h2, l2 = digest(ocols, orows)
    ok = (sorted(cols) == sorted(ocols) and stypes == dtypes and len(rows) == len(orows) and h1 == h2)
    if ok:
        return True, f"{len(rows)} rows"
    msg = [f"cols {sorted(cols)} vs {sorted(ocols)}; rows {len(rows)} vs {len(orows)}"]
    if stypes != dtypes:
        msg.append(f"types {stypes} vs {dtypes}")
    s1, s2 = set(l1), set(l2)
    msg += [f"spark : {x[:300]}" for x in sorted(s1 - s2)[:3]]
    msg += [f"oracle: {x[:300]}" for x in sorted(s2 - s1)[:3]]
    return False, "\n".join(msg)
