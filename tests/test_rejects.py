"""Messages that are none are kept with their text and the reason."""

import pytest
from conftest import multiset, plan
from pyspark.sql import functions as F

from eventlake.jobs import ingest as job
from eventlake.operators.decode import accepted, decode_json, decode_or_reject, rejects
from eventlake.schemas import struct
from eventlake.sources.events import file_source, read_events
from eventlake.sources.tables import read_table
from eventlake.streaming import ingest as streaming_ingest
from eventlake.streaming.ingest import ingest_or_reject
from eventlake.streaming.run import StreamFailure, run_all

SCHEMA = struct(k="double", t="string")
KINDS = {
    None: "absent", "": "empty", " \t": "empty", "not json": "malformed", '[{"k":1}]': "malformed", "null": "malformed",
    "3": "malformed", '{"k":1': "malformed", '{"k":"a","t":"x"}': "mistyped", '{"k":{"a":1}}': "mistyped",
    '{"k":1}': None, '{"k":NaN}': None, '{"j":1}': None, "{}": None, '{"k":null,"t":5}': None, '{"k":1} and more': None,
}


def test_kinds(spark):
    messages = spark.createDataFrame([(i, v) for i, v in enumerate(KINDS)], "id long, value string")
    decoded = decode_or_reject(messages, SCHEMA, keep=["id"])
    assert decoded.columns == ["id", "k", "t", "rejected"]
    got = {r.id: r.rejected for r in decoded.collect()}
    for i, (text, kind) in enumerate(KINDS.items()):
        assert (got[i] and tuple(got[i])) == (kind and (text, kind)), text
    # the fields are those of plain decoding, the good ones of a mistyped message too
    assert multiset(decoded.drop("rejected")) == multiset(decode_json(messages, SCHEMA, keep=["id"]))
    assert accepted(decoded).count() + rejects(decoded).count() == len(KINDS)
    binary = messages.withColumn("value", F.col("value").cast("binary"))
    assert multiset(decode_or_reject(binary, SCHEMA)) == multiset(decode_or_reject(messages, SCHEMA))
    with pytest.raises(ValueError):
        decode_or_reject(messages, struct(Rejected="string"))


def test_accepted_rows_are_parsed_once(spark):
    messages = spark.range(3).select(F.lit('{"k": 1}').alias("value"), F.rand().alias("x"))
    text = plan(accepted(decode_or_reject(messages, SCHEMA)).where("k > 0"))
    assert text.count("StructField(k,") <= 1 and "Python" not in text


def test_a_failed_write_leaves_no_duplicates(spark, path, monkeypatch):
    texts = [t for t in KINDS if t is not None]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path("topic"))
    write, calls = streaming_ingest.write_batch, []

    def fail_second(*arguments):
        calls.append(arguments[1])
        if len(calls) == 2:
            raise OSError("disk")
        write(*arguments)

    def run():
        messages = read_events(spark, file_source(path("topic")))
        run_all([ingest_or_reject(messages, path("good"), path("bad"), path("cp"), SCHEMA, trigger={"availableNow": True})])

    monkeypatch.setattr(streaming_ingest, "write_batch", fail_second)
    with pytest.raises(StreamFailure, match="disk"):
        run()
    run()
    good, bad = read_table(spark, path("good")), read_table(spark, path("bad"))
    assert good.count() + bad.count() == len(texts)
    assert sorted((r.text, r.kind) for r in bad.collect()) == sorted((t, KINDS[t]) for t in texts if KINDS[t])
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_or_reject(read_events(spark, file_source(path("topic"))), path("good"), path("new"), path("cp2"), SCHEMA)


def test_program(spark, path, monkeypatch):
    monkeypatch.setattr("eventlake.jobs.ingest.session", lambda name: spark)
    spark.createDataFrame([('{"timestamp": "t"}',), ("oops",)], "value string").write.text(path("topic"))
    common = ["--messages", path("topic"), "--output", path("good"), "--checkpoint", path("cp"), "--rejects", path("bad"), "--once"]
    job.main(common)
    assert read_table(spark, path("good")).select("timestamp").collect() == [("t",)]
    assert [tuple(r)[:2] for r in read_table(spark, path("bad")).collect()] == [("oops", "malformed")]
    with pytest.raises(SystemExit):
        job.main([*common, "--sink-option", "a=b"])
