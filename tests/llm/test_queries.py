"""Every registered corpus query on the smallest driver tables, against its SQL where it has some."""

import pytest

import __spark_entry__ as entry
import check_oracle
from granary.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.database(FOLDER)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, connection, name):
    verdict, _ = check_oracle.compare(spark, connection, FOLDER, name)
    assert not verdict.startswith("FAIL"), verdict


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
