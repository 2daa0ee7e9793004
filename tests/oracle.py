"""Runs a query and its SQL side by side, as the driver does."""

import glob
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(plain, value)) if isinstance(value, list) else value


def both(spark, query, sql):
    """(rows of Spark, rows of DuckDB), columns in order of their names."""
    df = query(spark, SF_DIR)
    names = sorted(df.columns)
    found = sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())
    with duckdb.connect() as c:
        for f in glob.glob(f"{SF_DIR}/*.parquet"):
            c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        cursor = c.execute(sql)
        order = [[d[0] for d in cursor.description].index(n) for n in names]
        return found, sorted(repr(tuple(plain(r[i]) for i in order)) for r in cursor.fetchall())
