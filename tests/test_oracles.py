"""Every registered query against its SQL, on all rows of the smallest tables."""

import re

import pytest
from compare import both, connect

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert {name for name in QUERIES if not TRAINING.match(name)} <= set(ORACLES) <= set(QUERIES)


# Those of the llm folder have tests of their own beside it.
TRAINING = re.compile(r"op\d+_|pipeline$")


@pytest.mark.parametrize("name", [name for name in QUERIES if not TRAINING.match(name)])
def test_query_equals_oracle(spark, connection, name):
    ours, theirs = both(spark, connection, QUERIES[name], ORACLES[name], FOLDER)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry_module.entry(spark).count() == 30
