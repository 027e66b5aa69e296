"""Run the reference SQL in an in-process DuckDB and compare it with a Spark result."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


def canonical(columns, rows):
    """Rows as sorted text tuples with columns in name order; types must agree to match."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{type(r[i]).__name__}:{r[i]!r}" for i in order) for r in rows)


def spark_result(df):
    return df.columns, [tuple(row) for row in df.collect()]


def duck_result(db, sql):
    cursor = db.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def difference(df, db, sql) -> str | None:
    """None where both engines agree in names, types and values."""
    names, rows = spark_result(df)
    other_names, other_rows = duck_result(db, sql)
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} != {sorted(other_names)}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)} rows"
    ours, theirs = canonical(names, rows), canonical(other_names, other_rows)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a}\n!= {b}"
    return None
