"""Run a registered query and its SQL, and compare names, row counts and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark, con, run, sql: str, sf_dir: str) -> tuple[int, str | None]:
    """Rows Spark returned, and what differs, if anything."""
    frame = run(spark, sf_dir)
    names = frame.columns
    rows = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(names) != sorted(sql_names):
        return len(rows), f"columns {sorted(names)} / {sorted(sql_names)}"
    if len(rows) != len(sql_rows):
        return len(rows), f"rows {len(rows)} / {len(sql_rows)}"
    ours, theirs = _sorted_rows(names, rows), _sorted_rows(sql_names, sql_rows)
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(rows), f"first difference:\n  {a}\n  {b}"
    return len(rows), None
