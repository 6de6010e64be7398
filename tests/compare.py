"""Compare a Spark result with a DuckDB result: columns, types, and rows regardless of order."""

from collections import Counter

import duckdb

RAW = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
}


def open_duckdb(sf_dir):
    con = duckdb.connect()
    for name in RAW.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in cursor.description]
    return columns, cursor.fetchall()


def _by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def _type(spark_type):
    return SAME_TYPE.get(spark_type) or spark_type.replace("decimal", "DECIMAL")


def differences(df, con, sql):
    """Empty when equal, else what differs."""
    columns, expected = duck_rows(con, sql)
    found = []
    left = {name: _type(kind) for name, kind in df.dtypes}
    right = {name: kind.replace(" ", "") for name, kind in columns}
    if left != right:
        found.append(f"columns {sorted(left.items() ^ right.items())}")
    rows = [tuple(row) for row in df.collect()]
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows, expected {len(expected)}")
    elif set(left) == set(right):
        a = _by_name(df.columns, rows)
        b = _by_name([name for name, _ in columns], expected)
        if a != b:
            found.append(f"only ours {list((a - b).items())[:3]}, only theirs {list((b - a).items())[:3]}")
    return found
