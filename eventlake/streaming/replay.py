"""A stated part of a stream, read again and put in place of the batches that held it.

A checkpoint knows what each batch read. A range of the source covers some
batches whole; one that it cuts is an error. What is read again is what those
batches read, no more, so messages that the stream has yet to see are left to
it. Stop the stream meanwhile; its checkpoint stays as it is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.events import EventSource
from eventlake.sources.paths import children, read_text

Offsets = dict[str, dict[str, int]]


@dataclass(frozen=True)
class Replay:
    """Messages of a range, and the batches that had read them; see :func:`eventlake.sinks.tables.replace_batches`."""

    batches: list[int]
    messages: DataFrame


def files_of_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path, modified, batch_id) of every file that a file stream has read, as its checkpoint tells."""
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    # compacted logs repeat earlier ones
    return lines.select(entry.alias("e")).select("e.path", F.timestamp_millis("e.timestamp").alias("modified"), F.col("e.batchId").alias("batch_id")).distinct()


def replay_files(spark: SparkSession, source: EventSource, checkpoint: str, start: datetime, end: datetime) -> Replay:
    """The files modified from ``start`` to ``end``, both included, of a file stream [STR6, STR2]."""
    inside = F.col("modified").between(F.lit(start), F.lit(end))
    read = files_of_batches(spark, checkpoint)
    batches = read.groupBy("batch_id").agg(F.bool_or(inside).alias("touched"), F.bool_and(inside).alias("whole"))
    touched = batches.where("touched").orderBy("batch_id").collect()
    cut = [row.batch_id for row in touched if not row.whole]
    if cut:
        raise ValueError(f"the range cuts batches {', '.join(map(str, cut))}; widen it to all of their files")
    if not touched:
        raise ValueError(f"no batch of {checkpoint} read a file of the range")
    ids = [row.batch_id for row in touched]
    paths = [row.path for row in read.where(F.col("batch_id").isin(ids)).select("path").distinct().collect()]
    # globs and the like were for finding the files
    options = {key: value for key, value in source.options.items() if key not in ("pathGlobFilter", "recursiveFileLookup")}
    reader = spark.read.format(source.format).options(**options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return Replay(ids, reader.load(paths))


def offsets_of_batches(spark: SparkSession, checkpoint: str) -> dict[int, tuple[Offsets, Offsets]]:
    """First offsets and those after the last, of each batch of a Kafka stream that its checkpoint still knows."""

    def last_line(path: str) -> Offsets | None:
        text = read_text(spark, path)
        return None if text is None else json.loads(text.strip().splitlines()[-1])

    numbers = sorted(int(name) for name in children(spark, f"{checkpoint}/offsets") if name.isdigit())
    ends = {n: last_line(f"{checkpoint}/offsets/{n}") for n in numbers}
    before = last_line(f"{checkpoint}/sources/0/0") if numbers and numbers[0] == 0 else None
    out = {}
    for n in numbers:
        if before is not None:
            out[n] = before, ends[n]
        before = ends[n]
    return out


def replay_kafka(spark: SparkSession, source: EventSource, checkpoint: str, start: Offsets, end: Offsets) -> Replay:
    """The offsets from ``start`` to before ``end`` (topic to partition to offset) of a Kafka stream [STR6, STR2].

    A partition that a batch or the range does not name begins at 0.
    """

    def at(offsets: Offsets, topic: str, partition: str) -> int:
        return offsets.get(topic, {}).get(partition, 0)

    batches, cut = {}, []
    for n, (first, last) in offsets_of_batches(spark, checkpoint).items():
        spans = [(at(first, t, p), at(last, t, p), at(start, t, p), at(end, t, p)) for t, parts in last.items() for p in parts]
        spans = [s for s in spans if s[0] < s[1]]
        if spans and all(low <= a and b <= high for a, b, low, high in spans):
            batches[n] = first, last
        elif any(a < high and low < b for a, b, low, high in spans):
            cut.append(n)
    if cut:
        raise ValueError(f"the range cuts batches {', '.join(map(str, cut))}; widen it to all of their offsets")
    if not batches:
        raise ValueError(f"no batch that {checkpoint} knows read offsets of the range")
    ids = sorted(batches)
    bounds = {"startingOffsets": json.dumps(batches[ids[0]][0]), "endingOffsets": json.dumps(batches[ids[-1]][1])}
    return Replay(ids, spark.read.format("kafka").options(**{**source.options, **bounds}).load())
