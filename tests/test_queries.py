"""Every registered query against its SQL counterpart on the small driver tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def database():
    return check_queries.database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    problem, _, _ = check_queries.compare(spark, database, FOLDER, name)
    assert not problem


def test_every_query_has_sql():
    corpus = {n for n in entry.queries() if n == "pipeline" or n.startswith("op")}  # tested in their own folder
    assert set(entry.queries()) - corpus == set(entry.oracle_sql()) - corpus


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
