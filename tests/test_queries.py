"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry
from tools.check_oracle import compare, connect
from workload.extracts import digits
from workload.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


def test_all_have_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


def test_numbers_are_padded_and_never_cut(spark, oracle):
    for n, text in ((7, "000007"), (123456, "123456"), (1234567, "1234567"), (2**40, str(2**40))):
        sql = f"SELECT {digits(str(n), 6)} AS x"
        assert spark.sql(sql).first().x == oracle.sql(sql).fetchall()[0][0] == text


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    result = compare(spark, oracle, FOLDER, name, QUERIES[name], ORACLE_SQL.get(name))
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    assert entry(spark).count() == 10
