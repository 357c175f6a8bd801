"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from pedalflow.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_operators_that_may_be_left_out_add_their_own_names():
    assert all(name == "pipeline" or re.fullmatch(r"op\d+_\w+", name) for name in set(queries()) - set(QUERIES))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, name) == ""


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "name", "surname", "total_trips", "avg_duration_minutes"]
