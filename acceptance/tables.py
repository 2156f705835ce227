"""The driver's tables in the roles of event stream and training table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.hashing import hash_bucket
from eventlake.functions.once import fields_once
from eventlake.operators.physical import held, spread, tasks_of
from eventlake.plans.training import fit, linear_regression
from eventlake.session import work_path
from eventlake.sinks.publish import publish
from eventlake.sources.events import file_source, read_events
from eventlake.sources.tables import read_table

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
DEVIATION = "deviation"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", columns=columns or None)


MESSAGE_FILES = 8  # as a topic has partitions


def published(spark: SparkSession, messages: DataFrame, path: str | None = None) -> str:
    """A directory of text messages in several files, new or added to, for a stream to follow.

    Few messages are dealt out to files by a shuffle; many come in parts of
    their own, which are written as they are.
    """
    path = path or work_path(spark, "messages")
    few = tasks_of(messages) <= MESSAGE_FILES
    publish(spread(messages, MESSAGE_FILES) if few else messages, "text", path)
    return path


def stream(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a directory as a stream."""
    return read_events(spark, file_source(path))


def signal() -> Column:
    """The part of the planted label that the features explain."""
    return F.col("l_quantity") * 0.3 + F.col("l_discount") * 40.0 - F.col("l_tax") * 20.0


def deviation() -> Column:
    """Planted label: the signal and noise between -1 and 1 from the row's key."""
    return signal() + hash_bucket(LINE_KEYS, 100) / F.lit(50.0) - F.lit(1.0)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES)
    return lines.select("*", fields_once(F.struct(deviation().alias(DEVIATION))))


def least_squares(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """Linear model of the planted label over the whole table; fitting reads its input three times."""
    with held(training_rows(spark, sf_dir).select(*LINE_FEATURES, DEVIATION)) as rows:
        return fit(rows, linear_regression(DEVIATION), LINE_FEATURES)


def rounded(name: str, digits: int) -> Column:
    """Rounded, with one kind of zero."""
    return (F.round(F.col(name), digits) + F.lit(0.0)).alias(name)
