"""Every registered query with SQL gives the same rows in DuckDB; the others give rows."""

import pytest

import __spark_entry__ as entry_points
from check_oracles import connect, difference
from conftest import SF_DIR

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
# The rest of the model queries take long and have tests of their own.
SHORT = ("m02", "m03", "m13", "m17", "m20", "m21", "s05")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR).toPandas(), db.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES and n.startswith(SHORT)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_train_and_test_rows(spark):
    done = entry_points.entry(spark)
    assert {r["part"] for r in done.select("part").distinct().collect()} == {"train", "test"}
