"""Every named query against its SQL in DuckDB, on the smallest data set."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from orderloom.queries.all import ENTRIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_matches_its_sql(spark, duck, name):
    entry = ENTRIES[name]
    out = entry.run(spark, SF_DIR)
    columns = sorted(out.columns)
    found = Counter(tuple(r[c] for c in columns) for r in out.collect())
    relation = duck.sql(entry.sql)
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    assert found == Counter(tuple(r[i] for i in order) for r in relation.fetchall())
