"""Every registered query against its SQL, on the smallest driver tables."""

from pathlib import Path

import pytest

pytest.importorskip("duckdb")
import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402
from workload import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.database(FOLDER)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, connection, name):
    verdict, _ = check_oracle.compare(spark, connection, FOLDER, name)
    assert not verdict.startswith("FAIL"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())
