"""Compare a Spark result with its DuckDB twin as bags of rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = (tuple(_cell(row[i]) for i in order) for row in rows)
    return sorted(cells, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both agree, else a short description."""
    names = sorted(d[0] for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} vs {names}"
    ours, theirs = spark_rows(df), duckdb_rows(con, sql)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{str(a)[:600]} vs {str(b)[:600]}"
    return None
