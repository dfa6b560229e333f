"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from rankloom.catalog.all_queries import REGISTRY

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
TABLES = "region nation customer supplier documents embeddings benchmark labels".split()


@pytest.fixture(scope="session")
def views():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (not isinstance(value, str) and pd.isna(value)):
        return None
    return float(value) if isinstance(value, (int, float)) or hasattr(value, "dtype") else value


def as_rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, row)) for row in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_against_sql(spark, views, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    want = views.sql(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_rows(got) == as_rows(want)


def test_entry(spark):
    assert contract.entry(spark).count() == 120


def test_every_inventory_id_is_covered():
    groups = {"S": 9, "P": 20, "J": 10, "A": 20, "W": 9, "T": 6, "U": 5, "F": 23, "X": 5, "C": 13}
    wanted = {f"{letter}{n}" for letter, count in groups.items() for n in range(1, count + 1)}
    covered = {i for registered in REGISTRY.values() for i in registered.covers}
    assert wanted - covered == set()
