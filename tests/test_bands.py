import math

import pytest
from conftest import plan
from pyspark.sql import functions as F

from eventlake.functions.bands import BandTable
from eventlake.operators.scoring import PREDICTION_NAME, critical_alerts, with_risk

LADDER = [
    (8.0, 0.95, "HIGH", "High Risk"),
    (7.9999, 0.80, "HIGH", "High Risk"),
    (5.0, 0.80, "HIGH", "High Risk"),
    (4.9999, 0.55, "MEDIUM", "Moderate Risk"),
    (2.0, 0.55, "MEDIUM", "Moderate Risk"),
    (1.99, 0.25, "LOW", "Low Risk"),
    (-1.0, 0.25, "LOW", "Low Risk"),
    (None, 0.25, "LOW", "Low Risk"),
    (math.nan, 0.95, "HIGH", "High Risk"),
    (math.inf, 0.95, "HIGH", "High Risk"),
]


def test_risk_ladder(spark):
    rows = spark.createDataFrame([(i, row[0]) for i, row in enumerate(LADDER)], f"id INT, {PREDICTION_NAME} DOUBLE")
    banded = {row.id: tuple(row)[2:] for row in with_risk(rows).collect()}
    assert banded == {i: row[1:] for i, row in enumerate(LADDER)}
    assert {row.id for row in critical_alerts(with_risk(rows)).collect()} == {0, 1, 2, 8, 9}


def test_bands_are_native_expressions(spark):
    assert "Python" not in plan(with_risk(spark.range(3).select(F.col("id").cast("double").alias(PREDICTION_NAME))))


@pytest.mark.parametrize("steps", [(), ((1.0, "a"), (1.0, "b")), ((1.0, "a"), (2.0, "b"))])
def test_bounds_must_fall(steps):
    with pytest.raises(ValueError, match="fall"):
        BandTable(steps, "c")
