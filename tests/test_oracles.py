"""Every registered query against its SQL oracle."""

import os
import re

import pytest
from conftest import plan

from acceptance.check import oracle_rows, spark_rows
from acceptance.oracles import ORACLES
from acceptance.queries import QUERIES
from acceptance.tables import DEVIATION, LINE_FEATURES, LINE_KEYS, training_rows
from eventlake.operators.split import hash_part
from eventlake.plans.training import train

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert not re.search("Cartesian|NestedLoop|Python|Pandas|ExistingRDD", plan(result))
    assert spark_rows(result) == oracle_rows(SF_DIR, ORACLES[name])


def test_model_leaderboard(spark):
    """The planted signal ranks the exact linear model first; all models beat the mean."""
    lines, part = training_rows(spark, SF_DIR), hash_part(LINE_KEYS)
    rows = train(lines, LINE_FEATURES, DEVIATION, part=part).leaderboard.collect()
    assert rows[0].name == "LinearRegression"
    assert [row.rmse for row in rows] == sorted(row.rmse for row in rows)
    assert all(row.r2 > 0.8 for row in rows)


def test_entry(spark):
    import __spark_entry__

    alerts = __spark_entry__.entry(spark)
    assert alerts.count() > 0
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLES.keys() <= __spark_entry__.oracle_sql().keys()
