"""Running a query and its SQL side by side and comparing the results as bags of rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql) -> list[str]:
    """What differs between the Spark result and the SQL result; empty if nothing does."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    ours, theirs = bag(df.columns, df.collect()), bag(names, result.fetchall())
    return [
        f"{side} only: {dict(list(rest.items())[:3])} of {sum(rest.values())}"
        for side, rest in (("spark", ours - theirs), ("sql", theirs - ours))
        if rest
    ]
