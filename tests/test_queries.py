"""Every registered query against plain SQL on the same tables."""

import os

import oracle
import pytest

from siltbed.registry import ENTRIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", [name for name, item in ENTRIES.items() if item.sql])
def test_query_equals_sql(spark, connection, name):
    assert oracle.differences(spark, connection, name, SF_DIR) == []


def test_every_query_has_sql():
    assert [name for name, item in ENTRIES.items() if not item.sql] == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
