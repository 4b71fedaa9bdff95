"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def kind(value):
    """Type family of a value, so that 1 and 1.0 and True are told apart."""
    return "null" if value is None else type(value).__name__


def differences(df, sql, con, limit=3):
    spark_cols, spark_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_cols, duck_rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_cols != duck_cols:
        return [f"columns {spark_cols} != {duck_cols}"]
    if len(spark_rows) != len(duck_rows):
        return [f"rows {len(spark_rows)} != {len(duck_rows)}"]
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows)
           if a != b or [kind(x) for x in a] != [kind(x) for x in b]]
    return [f"{len(bad)} rows differ, first {bad[:limit]}"] if bad else []
