"""Incomplete rows and number casts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_incomplete(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without null or NaN in any [FLT1] or the given [FLT2] columns; infinity passes.

    The null tests are also stated one by one, because only those reach a
    Parquet scan, which then skips pages of malformed messages.
    """
    names = rows.columns if columns is None else list(columns)
    present = reduce(and_, [F.col(f"`{name}`").isNotNull() for name in names])
    return rows.where(present).na.drop("any", subset=names)


def to_double(rows: DataFrame, columns: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Columns [PRJ4] as doubles under their own names, null where the text is no number [PRJ7]."""
    return rows.select(*keep, *[F.col(name).try_cast("double").alias(name) for name in columns])
