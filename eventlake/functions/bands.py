"""Threshold ladders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BandTable:
    """Steps of (lower bound, value), highest bound first, and a value below them all.

    A null input gets the default; NaN compares above every bound.
    """

    steps: tuple[tuple[float, float | str], ...]
    default: float | str

    def __post_init__(self):
        bounds = [bound for bound, _ in self.steps]
        if not bounds or any(low >= high for high, low in zip(bounds, bounds[1:])):
            raise ValueError("bounds must fall from step to step")

    def column(self, value: Column) -> Column:
        """The ladder as one CASE expression [FLT4]."""
        bound, result = self.steps[0]
        ladder = F.when(value >= F.lit(bound), F.lit(result))
        for bound, result in self.steps[1:]:
            ladder = ladder.when(value >= F.lit(bound), F.lit(result))
        return ladder.otherwise(F.lit(self.default))


# Bounds and names of the risk bands.
RISK_SCORE = BandTable(((8.0, 0.95), (5.0, 0.80), (2.0, 0.55)), 0.25)
SEVERITY = BandTable(((0.8, "HIGH"), (0.5, "MEDIUM")), "LOW")
RISK_CLASS = BandTable(((0.8, "High Risk"), (0.5, "Moderate Risk")), "Low Risk")
CRITICAL = "HIGH"


def risk_score(prediction: Column) -> Column:
    """Predicted deviation to risk score [FN1]."""
    return RISK_SCORE.column(prediction)


def severity(score: Column) -> Column:
    """Risk score to severity [FN2]."""
    return SEVERITY.column(score)


def risk_classification(score: Column) -> Column:
    """Risk score to risk class [FN3]."""
    return RISK_CLASS.column(score)
