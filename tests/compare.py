"""Side-by-side comparison of a query with its SQL counterpart."""

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = [tuple(row[i] for i in order) for row in rows]
    return names, sorted(values, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def _sequence(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(row[i] for i in order) for row in rows]


def spark_sequence(df):
    """Columns by name, rows as they come."""
    return _sequence(df.columns, [tuple(row) for row in df.collect()])


def duck_sequence(con, sql, order):
    result = con.execute(f"select * from ({sql}) order by {order}")
    return _sequence([d[0] for d in result.description], result.fetchall())


KINDS = {
    "boolean": "BOOLEAN",
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql):
    """Columns whose types differ between the engines."""
    described = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    return {
        name: (kind, described.get(name)) for name, kind in df.dtypes
        if KINDS.get(kind) != described.get(name)
    }
