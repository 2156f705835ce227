"""Rows to JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def _missing_as_nan(name: str, data_type) -> Column:
    if isinstance(data_type, (DoubleType, FloatType)):
        return F.coalesce(F.col(name), F.lit(float("nan"))).alias(name)
    if isinstance(data_type, StringType):
        return F.coalesce(F.col(name), F.lit('"NaN"')).alias(name)
    return F.col(name)


def to_messages(rows: DataFrame, missing_as_nan: bool = False) -> DataFrame:
    """One flat JSON object per row in ``value``, nulls spelled out [SNK6].

    ``missing_as_nan`` publishes missing numbers and texts as a producer does
    whose data frames mark them by NaN: numbers decode to NaN, texts to the
    five characters ``"NaN"``.
    """
    fields = [
        _missing_as_nan(f.name, f.dataType) if missing_as_nan else F.col(f.name) for f in rows.schema.fields
    ]
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def publish(messages: DataFrame, format: str = "kafka", path: str | None = None, **options: str) -> None:
    """Messages to a topic, or to a text directory that a file stream can follow [SNK6]. Batch only."""
    messages.write.format(format).mode("append").options(**options).save(path)
