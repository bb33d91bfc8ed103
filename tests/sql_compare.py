"""Compare a registered query with its SQL twin: column names, types, row count and values."""

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value)) if isinstance(value, float) and not math.isfinite(value) else float(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return (3, value.isoformat())
    return (4, str(value))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    problems = []
    if sorted(sql_types) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(sql_types)}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != sql_types[name]:
            problems.append(f"type of {name}: {kind} vs {sql_types[name]}")
    ours = normalised(df.columns, df.collect())
    theirs = normalised(list(sql_types), result.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows vs {len(theirs)}")
    if ours != theirs:
        first = next(((a, b) for a, b in zip(ours, theirs) if a != b), None)
        problems.append(f"values differ, first {first}")
    return problems
