"""Every registered query against its SQL counterpart on the smallest sample tables."""

from pathlib import Path

import pytest

from checks.compare import differences, duck
from checks.oracle import oracle_sql
from checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def db():
    return duck(SF_DIR)


def test_same_names():
    assert list(queries()) == list(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    assert differences(queries()[name](spark, SF_DIR), db, oracle_sql()[name]) == []
