"""Predictions, risk bands and alerts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.bands import CRITICAL, risk_classification, risk_score, severity
from eventlake.functions.once import fields_once
from eventlake.functions.stamps import processing_time
from eventlake.operators.clean import drop_incomplete
from eventlake.schemas import FEATURES

PREDICTION_NAME = "delivery_deviation_pred"


def with_risk(rows: DataFrame, prediction: str = PREDICTION_NAME) -> DataFrame:
    """Risk score, severity and risk class next to a prediction column [PRJ5]."""
    return rows.withColumn("risk_score", risk_score(F.col(prediction))).withColumns(
        {
            "severity": severity(F.col("risk_score")),
            "risk_classification": risk_classification(F.col("risk_score")),
        }
    )


def score(
    events: DataFrame,
    model: PipelineModel,
    features: Iterable[str] = FEATURES,
    keys: Iterable[str] = ("timestamp",),
    prediction: str = PREDICTION_NAME,
) -> DataFrame:
    """Complete events with model output and risk bands, in the prediction table's columns.

    The same call serves batches [ML7] and streams [STR4]. Rows need all
    features; ``keys`` may be null. The model runs once per row, also when the
    result is filtered by severity.
    """
    features, keys = list(features), list(keys)
    stamped = drop_incomplete(events, features).withColumn("scoring_time", processing_time())
    renamed = F.struct(F.col("prediction").alias(prediction))  # [PRJ6]
    predicted = model.transform(stamped).select("scoring_time", *keys, *features, fields_once(renamed))
    return with_risk(predicted, prediction)


def critical_alerts(predictions: DataFrame) -> DataFrame:
    """Predictions of the highest severity [FLT3]."""
    return predictions.where(F.col("severity") == CRITICAL)
