"""Queries against their SQL where customers lack orders, and on documents of many thousands of ids."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import check, connect
from test_queries import SF


def changed(folder, table, sql):
    """The small data folder with one table replaced."""
    for path in glob.glob(f"{SF}/*.parquet"):
        if os.path.basename(path) != f"{table}.parquet":
            os.symlink(path, folder / os.path.basename(path))
    duckdb.sql(f"COPY ({sql.format(table=f'{SF}/{table}.parquet')}) TO '{folder}/{table}.parquet'")
    return str(folder)


@pytest.mark.parametrize("key", ["A13", "P32", "P5", "P6", "S1", "W6", "J23", "U6"])
def test_customers_without_orders(spark, tmp_path, key):
    folder = changed(tmp_path, "orders", "SELECT * FROM '{table}' WHERE o_custkey % 3 <> 0")
    _, _, problem = check(spark, connect(folder), key, entry.queries()[key], entry.oracle_sql()[key], folder)
    assert problem is None, problem


def test_every_envelope_of_typing_files_is_read(spark, tmp_path):
    folder = changed(tmp_path, "documents", "SELECT * REPLACE (doc_id * 251 AS doc_id) FROM '{table}'")
    _, _, problem = check(spark, connect(folder), "S4", entry.queries()["S4"], entry.oracle_sql()["S4"], folder)
    assert problem is None, problem
