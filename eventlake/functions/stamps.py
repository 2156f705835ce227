"""Run ids and processing time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def processing_time() -> Column:
    """Time of the run, one value per query or micro-batch [FN4]."""
    return F.current_timestamp()


def run_id(moment: Column) -> Column:
    """Timestamp as ``yyyyMMdd_HHmmss`` [FN5]."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def model_path(base: str, name: Column, run: Column) -> Column:
    """``<base>/<name>_<run id>`` [FN6]."""
    return F.concat(F.lit(base.rstrip("/") + "/"), name, F.lit("_"), run)
