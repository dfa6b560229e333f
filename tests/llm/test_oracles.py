"""The queries that SQL can express, against DuckDB on the small tables."""

import duckdb
import pytest

from rankloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    columns = ", ".join(found.columns)
    wanted = connection.execute(f"SELECT {columns} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted) and wanted
