"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_check import connect, differences  # noqa: E402

from meterlake.llm.oracles import ORACLES  # noqa: E402
from meterlake.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_registered():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert len({name.split("_")[0] for name in QUERIES}) == 13
