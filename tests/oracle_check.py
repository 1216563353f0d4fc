"""Compare a Spark result with DuckDB's on the same tables, order-insensitively."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def mismatch(df, con, sql):
    """None when equal, else a description."""
    ours = df.collect()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = [dict(zip(columns, r)) for r in cursor.fetchall()]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    declared = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wanted = {c: TYPES[t] for c, t in df.dtypes}
    if declared != wanted:
        return f"types {wanted} vs {declared}"
    order = sorted(columns)
    a = Counter(tuple(r[c] for c in order) for r in ours)
    b = Counter(tuple(r[c] for c in order) for r in theirs)
    if a == b:
        return None
    return (
        f"{sum(a.values())} vs {sum(b.values())} rows; "
        f"only Spark {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}"
    )
