"""Regression quality in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(label: str, prediction: str) -> list[Column]:
    """RMSE [AGG2], MAE [AGG3] and R² [AGG4] as aggregates that share one pass.

    The total sum of squares is variance times count, which does not cancel the
    way Σy² - nȳ² does. A constant label divides by zero as floating point does.
    """
    actual = F.when(F.col(prediction).isNotNull(), F.col(label))
    error = F.col(label) - F.col(prediction)
    squares = F.sum(error * error)
    total = F.var_pop(actual) * F.count(actual)
    unexplained = F.when(total != 0, squares / total).otherwise(
        F.when(squares > 0, F.lit(float("inf"))).when(squares == 0, F.lit(float("nan")))
    )
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - unexplained).alias("r2"),
    ]


def regression_metrics(rows: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row with the row count [AGG1], RMSE, MAE and R² of a prediction column. Batch only."""
    return rows.agg(F.count(F.lit(1)).alias("n"), *metric_columns(label, prediction))
