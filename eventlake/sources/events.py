"""Event streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class EventSource:
    """Where messages come from. Every kind yields a ``value`` column or typed columns."""

    format: str
    path: str | None = None
    schema: StructType | None = None
    options: dict[str, str] = field(default_factory=dict)


def kafka_source(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool | None = None,
    security_protocol: str | None = None,
    **options: str,
) -> EventSource:
    """Topic subscription [SRC1], start [SRC2], data-loss [SRC3] and transport [SRC4] policies.

    ``options`` go through unchanged, such as ``maxOffsetsPerTrigger`` to bound
    a backlog's batches or ``minPartitions`` to read with more tasks than the
    topic has partitions.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if fail_on_data_loss is not None:
        settings["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if security_protocol is not None:
        settings["kafka.security.protocol"] = security_protocol
    return EventSource("kafka", options={**settings, **options})


def file_source(
    path: str,
    format: str = "text",
    schema: StructType | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    **options: str,
) -> EventSource:
    """A directory or glob of files read as a stream, one message per row [SRC1].

    Files have no "latest" position, so only ``earliest`` is accepted [SRC2];
    tolerating data loss means ignoring files that vanish before they are read [SRC3].
    """
    if starting_offsets != "earliest":
        raise ValueError("a file stream always starts from all its files")
    settings = {} if fail_on_data_loss else {"ignoreMissingFiles": "true"}
    return EventSource(format, path, schema, {**settings, **options})


def read_events(spark: SparkSession, source: EventSource) -> DataFrame:
    """Streaming DataFrame over a source [SRC1]."""
    reader = spark.readStream.format(source.format).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.load(source.path)
