"""Field lists of the tables."""

from __future__ import annotations

from pyspark.sql.types import StructType


def struct(**fields: str) -> StructType:
    """Nullable fields from names and type names, such as ``struct(id="long", name="string")``."""
    schema = StructType()
    for name, type_name in fields.items():
        schema = schema.add(name, type_name)
    return schema


# Event fields, feature order, label, and the columns of the written tables.
EVENT = struct(
    timestamp="string",
    fuel_consumption_rate="double",
    eta_variation_hours="double",
    traffic_congestion_level="double",
    weather_condition_severity="double",
    lead_time_days="double",
    iot_temperature="double",
    cargo_condition_status="string",
    route_risk_level="double",
    customs_clearance_time="double",
    driver_behavior_score="double",
    fatigue_monitoring_score="double",
    delivery_time_deviation="double",
    delay_probability="double",
    risk_classification="string",
)

FEATURES = (
    "fuel_consumption_rate",
    "eta_variation_hours",
    "traffic_congestion_level",
    "weather_condition_severity",
    "lead_time_days",
    "iot_temperature",
    "route_risk_level",
    "customs_clearance_time",
    "driver_behavior_score",
    "fatigue_monitoring_score",
)
LABEL = "delivery_time_deviation"

MODEL_POINTER = struct(model_path="string", timestamp="string", model_name="string", rmse="double")
LEADERBOARD = struct(name="string", rmse="double", mae="double", r2="double")


def scoring_schema(features=FEATURES, keys=("timestamp",)) -> StructType:
    """What scoring reads of a message: text keys and the features, nothing else."""
    return struct(**dict.fromkeys(keys, "string"), **dict.fromkeys(features, "double"))


SCORE_EVENT = scoring_schema()

PREDICTION = struct(
    scoring_time="timestamp",
    **{field.name: field.dataType.typeName() for field in SCORE_EVENT},
    delivery_deviation_pred="double",
    risk_score="double",
    severity="string",
    risk_classification="string",
)
