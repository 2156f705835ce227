"""A part of a stream is read again in place of the batches that held it."""

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventlake.operators.decode import accepted, decode_or_reject, rejects
from eventlake.schemas import struct
from eventlake.sinks import tables
from eventlake.sinks.tables import compact, replace_batches, write_batch
from eventlake.sources.events import file_source, kafka_source, read_events
from eventlake.sources.tables import read_table
from eventlake.streaming.ingest import ingest, ingest_or_reject
from eventlake.streaming.replay import files_of_batches, offsets_of_batches, replay_files, replay_kafka
from eventlake.streaming.run import run_all

SCHEMA = struct(k="long")
ONCE = {"availableNow": True}


def send(spark, path, values):
    spark.createDataFrame([(f'{{"k": {v}}}' if v >= 0 else "oops",) for v in values], "value string").coalesce(1).write.mode("append").text(path("topic"))


def run(spark, path):
    messages = read_events(spark, file_source(path("topic"), maxFilesPerTrigger="2"))
    run_all([ingest_or_reject(messages, path("good"), path("bad"), path("cp"), SCHEMA, trigger=ONCE)])


def rows(spark, path):
    return sorted((r.batch_id, r.k) for r in read_table(spark, path("good")).collect())


@pytest.fixture
def three_batches(spark, path):
    for values in ([1, -1], [2, 3], [4]):
        send(spark, path, values)
        run(spark, path)


def span(spark, path, batch):
    files = files_of_batches(spark, path("cp")).where(F.col("batch_id") == batch)
    return files.agg(F.min("modified"), F.max("modified")).first()


def test_a_range_of_files(spark, path, three_batches):
    send(spark, path, [9])  # not yet seen by the stream
    far = span(spark, path, 2)[1] + timedelta(days=1)
    again = replay_files(spark, file_source(path("topic")), path("cp"), span(spark, path, 1)[0], far)
    assert again.batches == [1, 2] and again.messages.count() == 3
    decoded = decode_or_reject(again.messages, SCHEMA)
    replace_batches(accepted(decoded).withColumn("k", F.col("k") * 10), path("good"), again.batches)
    replace_batches(rejects(decoded), path("bad"), again.batches)
    assert rows(spark, path) == [(0, 1), (2, 20), (2, 30), (2, 40)]
    assert [r.text for r in read_table(spark, path("bad")).collect()] == ["oops"]
    run(spark, path)  # the stream goes on where it was
    assert rows(spark, path)[-1] == (3, 9)
    with pytest.raises(ValueError, match="no batch"):
        replay_files(spark, file_source(path("topic")), path("cp"), far, far)


def test_a_range_that_cuts_a_batch_is_refused(spark, path):
    send(spark, path, [1])
    send(spark, path, [2])
    run(spark, path)
    first, last = span(spark, path, 0)
    assert first < last
    with pytest.raises(ValueError, match="cuts batches 0"):
        replay_files(spark, file_source(path("topic")), path("cp"), first, last - timedelta(milliseconds=1))


def test_more_batches_than_one_log(spark, path):
    """The checkpoint puts older entries together every ten batches."""
    for k in range(12):
        send(spark, path, [k])
    messages = read_events(spark, file_source(path("topic"), maxFilesPerTrigger="1"))
    run_all([ingest_or_reject(messages, path("good"), path("bad"), path("cp"), SCHEMA, trigger=ONCE)])
    files = files_of_batches(spark, path("cp")).collect()
    assert sorted(r.batch_id for r in files) == list(range(12)) and len({r.path for r in files}) == 12


@pytest.mark.parametrize("step", [1, 2])
def test_a_replacement_cut_short_is_finished(spark, path, monkeypatch, step):
    for batch in range(4):
        write_batch(spark.range(batch, batch + 1).toDF("id"), path("t"), batch)
    real, calls = tables.rename, []

    def failing(*arguments):
        calls.append(arguments)
        if len(calls) == step:
            raise OSError("away")
        return real(*arguments)

    monkeypatch.setattr(tables, "rename", failing)
    with pytest.raises(OSError):
        replace_batches(spark.range(100, 101).toDF("id"), path("t"), [1, 2])
    monkeypatch.undo()
    replace_batches(spark.range(200, 201).toDF("id"), path("t"), [3])
    got = sorted((r.batch_id, r.id) for r in read_table(spark, path("t")).collect())
    assert got == ([(0, 0), (1, 1), (2, 2), (3, 200)] if step == 1 else [(0, 0), (2, 100), (3, 200)])


def test_what_was_put_together_is_replaced_together(spark, path):
    for batch in range(4):
        write_batch(spark.range(batch, batch + 1).toDF("id"), path("t"), batch)
    compact(spark, path("t"), keep=1)
    with pytest.raises(ValueError, match="0 to 2"):
        replace_batches(spark.range(1), path("t"), [1])
    replace_batches(spark.range(50, 51).toDF("id"), path("t"), [0, 1, 2])
    assert sorted(r.id for r in read_table(spark, path("t")).collect()) == [3, 50]


def test_file_sinks_are_refused(spark, path):
    send(spark, path, [1])
    run_all([ingest(read_events(spark, file_source(path("topic"))), path("t"), path("cp"), SCHEMA, trigger=ONCE)])
    with pytest.raises(ValueError, match="version"):
        replace_batches(spark.range(1).toDF("k"), path("t"), [0])


def test_offsets_of_a_topic(spark, path, monkeypatch):
    """The checkpoint of a Kafka stream, as the engine writes it."""
    base = Path(path("cp"))
    (base / "offsets").mkdir(parents=True)
    (base / "sources" / "0").mkdir(parents=True)
    (base / "sources" / "0" / "0").write_text('\0v1\n{"t":{"0":5,"1":0}}')
    for n, ends in enumerate(({"0": 7, "1": 3}, {"0": 9, "1": 3}, {"0": 12, "1": 8})):
        (base / "offsets" / str(n)).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{json.dumps({"t": ends})}')
    known = offsets_of_batches(spark, path("cp"))
    assert known[0] == ({"t": {"0": 5, "1": 0}}, {"t": {"0": 7, "1": 3}}) and sorted(known) == [0, 1, 2]
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return "messages"

    class Session:
        read = Reader()

    source = kafka_source("hosts", "t", "latest")
    monkeypatch.setattr("eventlake.streaming.replay.offsets_of_batches", lambda spark, checkpoint: known)
    with pytest.raises(ValueError, match="cuts batches 0"):
        replay_kafka(Session(), source, path("cp"), {"t": {"0": 6}}, {"t": {"0": 9, "1": 3}})
    again = replay_kafka(Session(), source, path("cp"), {"t": {"0": 7, "1": 3}}, {"t": {"0": 20, "1": 9}})
    assert again.batches == [1, 2] and again.messages == "messages"
    assert asked["format"] == "kafka" and json.loads(asked["startingOffsets"]) == known[1][0]
    assert json.loads(asked["endingOffsets"]) == known[2][1]
