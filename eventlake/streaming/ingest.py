"""Append streams."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventlake.operators.decode import accepted, decode_json, decode_or_reject, rejects
from eventlake.operators.physical import held
from eventlake.schemas import EVENT
from eventlake.sinks.tables import require_typed, write_batch
from eventlake.streaming.paths import require_paired


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    trigger: dict | None = None,
    name: str | None = None,
    partition_by: Iterable[str] = (),
    merge_schema: bool = False,
    options: Mapping[str, str] | None = None,
    allow_existing: bool = False,
) -> StreamingQuery:
    """Rows appended to a table exactly once per checkpoint [SNK1, STR1, STR2].

    Without a ``trigger`` such as ``{"availableNow": True}`` or
    ``{"processingTime": "1 minute"}`` batches follow each other at once.
    ``options`` go to the writer, such as ``retention`` of a file sink's list.
    A new checkpoint on an output that holds data is refused, whatever the
    format, since a lost checkpoint would double the table; a Delta table that
    is meant to take rows of several streams needs ``allow_existing``.
    """
    if not (allow_existing and format == "delta"):
        require_paired(rows.sparkSession, checkpoint, path)
    writer = (
        rows.writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    writer = writer.options(**(options or {}))
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def ingest(
    messages: DataFrame, path: str, checkpoint: str, schema: StructType = EVENT, value: str = "value", **options
) -> StreamingQuery:
    """Messages decoded and appended; malformed ones become rows of nulls [STR1]."""
    return append_stream(decode_json(messages, schema, value), path, checkpoint, **options)


def ingest_or_reject(
    messages: DataFrame,
    path: str,
    rejects_path: str,
    checkpoint: str,
    schema: StructType = EVENT,
    value: str = "value",
    format: str = "parquet",
    trigger: dict | None = None,
    name: str = "ingest",
) -> StreamingQuery:
    """As :func:`ingest`, with what is no message in a second table, text and kind [PRJ2, STR1].

    Both are written from one parse of a micro-batch, held for the two writes;
    blocks lost in between are parsed again to the same rows. Batches have a
    ``batch_id`` and a retried one replaces itself in both tables, so accepted
    and rejected rows together are the messages of the stream.
    """
    require_typed(format)
    require_paired(messages.sparkSession, checkpoint, path, rejects_path)

    def write_both(batch: DataFrame, batch_id: int) -> None:
        with held(decode_or_reject(batch, schema, value)) as decoded:
            write_batch(accepted(decoded), path, batch_id, format, f"{name}-accepted:{checkpoint}")
            write_batch(rejects(decoded), rejects_path, batch_id, format, f"{name}-rejected:{checkpoint}")

    writer = (
        messages.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_both)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def console(rows: DataFrame, trigger: dict | None = None, name: str | None = None, n: int = 20) -> StreamingQuery:
    """The first ``n`` rows of each batch, untruncated, on the driver's standard output, for debugging [SNK3].

    ``n`` is a cap on what is printed; a debugging print, not a sink of all rows.
    """
    writer = rows.writeStream.format("console").outputMode("append").options(truncate="false", numRows=str(n))
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
