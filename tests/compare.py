"""Compares a registered query with its SQL, values and order of rows aside."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def type_differences(spark, con, query, sql, sf_dir):
    """Columns whose type differs between the query and its SQL."""
    found = {name: _SQL_TYPES.get(kind, kind) for name, kind in query(spark, sf_dir).dtypes}
    expected = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {name: (found[name], expected.get(name)) for name in found if found[name] != expected.get(name)}


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    return found, expected
