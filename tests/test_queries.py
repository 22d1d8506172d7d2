"""Every registered query against its SQL, on whole tables at the smallest scale."""

from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = driver.registry.QUERIES, driver.oracle.statements()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint", "VARCHAR": "string",
    "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    described = {column[0]: TYPES[str(column[1])] for column in result.description}
    assert dict(df.dtypes) == described
    order = sorted(described)
    position = [list(described).index(c) for c in order]
    expected = Counter(tuple(r[i] for i in position) for r in result.fetchall())
    assert Counter(tuple(r) for r in df.select(*order).collect()) == expected


def test_entry_has_rows_and_a_stable_schema(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.schema == driver.entry(spark).schema
    assert not any(isinstance(v, datetime) for v in df.first())


def test_the_sample_is_that_of_its_cap(spark):
    sampled, points = (QUERIES[q](spark, SF_DIR).count() for q in ("point_sample", "points_of_year"))
    assert sampled == 100 < points
