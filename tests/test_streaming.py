"""Streams give the rows of the batch, once, through restarts and failures."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from conftest import multiset, plan
from pyspark.sql import functions as F

from eventlake.operators.decode import decode_json
from eventlake.operators.scoring import critical_alerts, score
from eventlake.plans.registry import ModelRegistry
from eventlake.plans.training import fit, linear_regression
from eventlake.schemas import EVENT, LABEL, PREDICTION
from eventlake.sinks import tables
from eventlake.sinks.publish import publish, to_messages
from eventlake.sources.events import file_source, read_events
from eventlake.sources.tables import read_table
from eventlake.streaming import scoring as streaming_scoring
from eventlake.streaming.ingest import console, ingest
from eventlake.streaming.paths import StreamPaths
from eventlake.streaming.progress import BatchCounts, scored_counts
from eventlake.streaming.run import StreamFailure, run_all
from eventlake.streaming.scoring import start_scoring

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def model(events):
    return fit(events, linear_regression())


@pytest.fixture
def topic(spark, events, path):
    """A directory of messages in four files, two of them with malformed lines."""
    good = to_messages(events.limit(100)).repartition(2)
    bad = spark.createDataFrame([("not json",), ('{"timestamp": "t", "x": 1}',), ("",)], "value STRING").repartition(2)
    publish(good, "text", path("topic"))
    publish(bad, "text", path("topic"))
    return path("topic")


def messages(spark, topic, **options):
    return read_events(spark, file_source(topic, **options))


def more(spark, events, topic, n=5):
    publish(to_messages(events.limit(n)), "text", topic)


def test_ingest_equals_the_batch(spark, topic, path):
    run_all([ingest(messages(spark, topic, maxFilesPerTrigger="1"), path("out"), path("cp"), trigger=ONCE)])
    table = read_table(spark, path("out"))
    assert table.schema == EVENT
    assert multiset(table) == multiset(decode_json(read_table(spark, topic, "text"), EVENT))
    assert table.where(" AND ".join(f"{name} IS NULL" for name in EVENT.names)).count() == 2


def test_restart_adds_only_what_is_new(spark, events, topic, path):
    for expected in (103, 103):
        run_all([ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE)])
        assert read_table(spark, path("out")).count() == expected
    more(spark, events, topic)
    run_all([ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE)])
    assert read_table(spark, path("out")).count() == 108


def test_partitioned_ingest(spark, topic, path):
    run_all(
        [ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE, partition_by=["risk_classification"])]
    )
    assert read_table(spark, path("out")).where("risk_classification = 'unknown'").count() == 100


def test_fresh_checkpoint_on_an_old_table_is_refused(spark, topic, path, model):
    run_all([ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE)])
    with pytest.raises(ValueError, match="next version"):
        ingest(messages(spark, topic), path("out"), path("cp2"), trigger=ONCE)
    run_all(start_scoring(messages(spark, topic), model, path("pred"), path("alerts"), path("cp3"), trigger=ONCE))
    with pytest.raises(ValueError, match="next version"):
        start_scoring(messages(spark, topic), model, path("pred"), path("alerts"), path("cp4"), trigger=ONCE)


def test_reprocessing_takes_new_paths(spark, topic, path):
    paths = StreamPaths(path("lake"), path("checkpoints"))
    assert paths.output("events").endswith("/lake/events/v1") and paths.checkpoint.endswith("/checkpoints/v1")
    again = paths.reprocess()
    assert again.output("events").endswith("/lake/events/v2") and again.checkpoint.endswith("/checkpoints/v2")
    for each in (paths, again):
        run_all([ingest(messages(spark, topic), each.output("events"), each.checkpoint, trigger=ONCE)])
    assert multiset(read_table(spark, paths.output("events"))) == multiset(read_table(spark, again.output("events")))


def scored(spark, path):
    return (read_table(spark, path(name)) for name in ("pred", "alerts"))


def run_scoring(spark, topic, model, path, **options):
    source = messages(spark, topic, maxFilesPerTrigger="1")
    run_all(start_scoring(source, model, path("pred"), path("alerts"), path("cp"), trigger=ONCE, **options))


def test_scoring_equals_the_batch(spark, events, topic, path, model):
    run_scoring(spark, topic, model, path)
    predictions, alerts = scored(spark, path)
    assert predictions.columns == [*PREDICTION.names, "batch_id"]
    batch = score(decode_json(read_table(spark, topic, "text"), EVENT), model)
    drop = ["scoring_time", "batch_id"]
    assert multiset(predictions.drop(*drop)) == multiset(batch.drop("scoring_time"))
    assert 0 < alerts.count() < 100
    assert multiset(alerts.drop(*drop)) == multiset(critical_alerts(batch).drop("scoring_time"))


def test_both_tables_share_scoring_times_by_batch(spark, topic, path, model):
    run_scoring(spark, topic, model, path)
    predictions, alerts = scored(spark, path)
    assert multiset(alerts) == multiset(critical_alerts(predictions))
    stamps = predictions.groupBy("batch_id").agg(F.countDistinct("scoring_time").alias("n"))
    assert {row.n for row in stamps.collect()} == {1}
    assert predictions.select("scoring_time").distinct().count() > 1


def test_alerts_are_filtered_in_the_scan_of_one_committed_batch(spark, topic, path, model):
    run_scoring(spark, topic, model, path)
    committed = tables.read_batch(spark, path("pred"), 1)
    assert "batch_id" not in committed.columns
    assert all("/batch_id=1/" in name for name in committed.inputFiles())
    assert "EqualTo(severity,HIGH)" in plan(critical_alerts(committed))


def test_restarted_scoring_adds_only_what_is_new(spark, events, topic, path, model):
    for expected in (100, 100):
        run_scoring(spark, topic, model, path)
        assert read_table(spark, path("pred")).count() == expected
    more(spark, events, topic)
    run_scoring(spark, topic, model, path)
    assert read_table(spark, path("pred")).count() == 105


def test_failure_between_the_writes_leaves_no_duplicates(spark, topic, path, model, monkeypatch):
    write = tables.write_batch
    calls = []

    def failing(rows, target, *rest):
        calls.append(target)
        if len(calls) == 4:  # the second batch's alerts
            raise OSError("alerts store is away")
        write(rows, target, *rest)

    monkeypatch.setattr(streaming_scoring, "write_batch", failing)
    with pytest.raises(StreamFailure, match="alerts store is away"):
        run_scoring(spark, topic, model, path)
    assert calls == [path("pred"), path("alerts")] * 2
    run_scoring(spark, topic, model, path)
    predictions, alerts = scored(spark, path)
    assert predictions.count() == 100
    assert multiset(alerts) == multiset(critical_alerts(predictions))


def test_predictions_may_gain_columns(spark, events, topic, path, model):
    run_scoring(spark, topic, model, path)
    publish(to_messages(events.limit(5)), "text", topic)
    run_scoring(spark, topic, model, path, keys=["timestamp", "cargo_condition_status"])
    table = read_table(spark, path("pred"), merge_schema=True)
    assert table.count() == 105
    assert table.where("cargo_condition_status = 'ok'").count() == 5


def test_debug_prints_events(spark, topic, path, model):
    source = messages(spark, topic)
    queries = start_scoring(
        source, model, path("pred"), path("alerts"), path("cp"), debug=True, trigger=ONCE
    )
    assert [query.name for query in queries] == ["scoring", "scoring-debug"]
    run_all(queries)


def test_every_failed_query_is_named(spark, topic, path):
    bad = messages(spark, topic).select(F.raise_error(F.lit("first breaks")).cast("string").alias("value"))
    endless = ingest(messages(spark, topic), path("out"), path("cp"), name="endless")
    broken = ingest(bad, path("out2"), path("cp2"), name="broken")
    with pytest.raises(StreamFailure, match="broken: .*first breaks"):
        run_all([endless, broken])
    assert not endless.isActive and not broken.isActive


def test_failure_of_a_query_that_has_ended_before(spark, topic, path):
    bad = messages(spark, topic).select(F.raise_error(F.lit("early")).cast("string").alias("value"))
    queries = [
        console(messages(spark, topic), ONCE, "fine"),
        ingest(bad, path("out"), path("cp"), name="broken", trigger=ONCE),
    ]
    for query in queries:
        try:
            query.awaitTermination()
        except Exception:
            pass
    with pytest.raises(StreamFailure, match="broken"):
        run_all(queries)


def test_no_shuffle_and_no_python_from_message_to_prediction(spark, topic, model):
    text = plan(score(streaming_scoring.decode_events(read_table(spark, topic, "text")), model))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("from_json(") == 1


def test_rows_appended_beside_a_stream_are_refused(spark, events, topic, path):
    run_all([ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE)])
    with pytest.raises(ValueError, match="second table"):
        tables.append_table(events, path("out"))
    assert read_table(spark, path("out")).count() == 103


@pytest.mark.parametrize("format", ["json", "csv", "text"])
def test_formats_without_a_schema_are_refused(spark, topic, path, model, format):
    with pytest.raises(ValueError, match="stores its schema"):
        run_scoring(spark, topic, model, path, format=format)


def test_scoring_in_orc(spark, topic, path, model):
    run_scoring(spark, topic, model, path, format="orc")
    assert spark.read.orc(path("pred")).count() == 100


def test_a_batch_without_complete_rows(spark, path, model):
    publish(spark.createDataFrame([("not json",)], "value STRING"), "text", path("bad"))
    run_scoring(spark, path("bad"), model, path)
    assert read_table(spark, path("alerts")).count() == 0


def test_fresh_checkpoint_on_a_delta_table_is_refused(spark, topic, path):
    """The guard comes before the writer, so it needs no Delta."""
    spark.range(1).write.parquet(path("lake"))
    with pytest.raises(ValueError, match="next version"):
        ingest(messages(spark, topic), path("lake"), path("cp"), format="delta", trigger=ONCE)
    with pytest.raises(Exception, match="(?i)delta"):
        ingest(messages(spark, topic), path("lake"), path("cp"), format="delta", trigger=ONCE, allow_existing=True)


def test_writer_options(spark, topic, path):
    out = ingest(messages(spark, topic), path("out"), path("cp"), trigger=ONCE, options={"compression": "gzip"})
    run_all([out])
    assert all(".gz." in name for name in read_table(spark, path("out")).inputFiles())


def test_console_rows_are_a_stated_number():
    """What the writer is told; its print goes past the test, to the Java process's own output."""
    told = {}

    class Writer:
        def __getattr__(self, step):
            return lambda *values, **options: told.update({step: values or options}) or self

    console(SimpleNamespace(writeStream=Writer()), ONCE, "few", n=3)
    assert told["options"] == {"truncate": "false", "numRows": "3"} and told["format"] == ("console",)


def test_compaction_keeps_every_row_once(spark, path):
    for batch in range(6):
        tables.write_batch(spark.range(batch * 10, batch * 10 + 10).toDF("id"), path("t"), batch)
    assert tables.compact(spark, path("t"), keep=2) == 4
    table = read_table(spark, path("t"))
    assert sorted(r.id for r in table.collect()) == list(range(60))
    assert {r.batch_id for r in table.select("batch_id").distinct().collect()} == {3, 4, 5}
    # a late retry of a batch that is folded in, and one of a batch that is not
    tables.write_batch(spark.range(20, 30).toDF("id"), path("t"), 2)
    tables.write_batch(spark.range(30, 40).toDF("id"), path("t"), 3)
    tables.write_batch(spark.range(40, 50).toDF("id"), path("t"), 4)
    assert sorted(r.id for r in read_table(spark, path("t")).collect()) == list(range(60))
    for batch in (6, 7):
        tables.write_batch(spark.range(batch * 10, batch * 10 + 10).toDF("id").withColumn("more", F.lit(1)), path("t"), batch)
    assert tables.compact(spark, path("t"), keep=1, partitions=1) == 4
    assert sorted(r.id for r in read_table(spark, path("t")).collect()) == list(range(80))
    assert tables.compact(spark, path("t"), keep=1) == 0


def test_the_last_batch_is_never_folded_in(spark, path):
    """A stream that tries its last batch again finds only that batch's rows there."""
    for batch in range(3):
        tables.write_batch(spark.range(batch * 5, batch * 5 + 5).toDF("id"), path("t"), batch)
    for keep in (0, -1):
        with pytest.raises(ValueError, match="keep"):
            tables.compact(spark, path("t"), keep=keep)
    assert tables.compact(spark, path("t"), keep=1) == 2
    tables.write_batch(spark.range(10, 15).toDF("id"), path("t"), 2)
    assert sorted(r.id for r in tables.read_batch(spark, path("t"), 2).collect()) == list(range(10, 15))


@pytest.mark.parametrize("step", ["remove", "rename"])
def test_a_compaction_cut_short_is_finished_by_the_next(spark, path, monkeypatch, step):
    for batch in range(4):
        tables.write_batch(spark.range(batch * 10, batch * 10 + 10).toDF("id"), path("t"), batch)
    real, calls = getattr(tables, step), []

    def failing(*arguments):
        calls.append(arguments)
        if len(calls) == 2:
            raise OSError("away")
        return real(*arguments)

    monkeypatch.setattr(tables, step, failing)
    with pytest.raises(OSError):
        tables.compact(spark, path("t"), keep=1)
    monkeypatch.undo()
    tables.compact(spark, path("t"), keep=1)
    assert sorted(r.id for r in read_table(spark, path("t")).collect()) == list(range(40))


@pytest.fixture
def registry(spark, model, path):
    registry = ModelRegistry(spark, path("models"))
    registry.publish(model, "First", 1.0, datetime(2024, 1, 1))
    return registry


def test_a_retried_batch_keeps_its_model(spark, events, topic, path, model, registry, monkeypatch):
    """The second write fails; a newer model is published; the retry scores by the model on record, the next batch by the new one."""
    write, calls = streaming_scoring.write_batch, []

    def fail_second(*arguments):
        calls.append(arguments[1])
        if len(calls) == 2:
            raise OSError("disk")
        write(*arguments)

    def run():
        messages = read_events(spark, file_source(topic))
        run_all(start_scoring(messages, registry, path("pred"), path("alerts"), path("cp"), trigger=ONCE))

    monkeypatch.setattr(streaming_scoring, "write_batch", fail_second)
    with pytest.raises(StreamFailure, match="disk"):
        run()
    other = fit(events.withColumn(LABEL, F.col(LABEL) + 1000), linear_regression())
    newer = registry.publish(other, "Second", 1.0, datetime(2024, 1, 2))
    run()
    clean = score(decode_json(read_table(spark, topic, "text"), EVENT), model)
    assert read_table(spark, path("pred")).agg(F.max("delivery_deviation_pred")).first()[0] < 500
    assert read_table(spark, path("pred")).count() == clean.count()
    publish(to_messages(events.limit(10)), "text", topic)
    run()
    late = read_table(spark, path("pred")).where("batch_id = 1")
    assert late.count() == 10 and late.agg(F.min("delivery_deviation_pred")).first()[0] > 500
    assert streaming_scoring.model_of_batch(registry, path("cp"), 1) == newer
    assert streaming_scoring.model_of_batch(registry, path("cp"), 0).endswith("First_20240101_000000")


@pytest.mark.parametrize("follow", [False, True])
def test_counts_of_batches(spark, topic, path, model, registry, follow):
    reported = []
    counts = BatchCounts(reported.append)
    queries = start_scoring(
        read_events(spark, file_source(topic, maxFilesPerTrigger="1")),
        registry if follow else model,
        *(path("pred"), path("alerts"), path("cp")),
        trigger=ONCE,
        counts=counts,
        name="counted",
        debug=True,
    )
    run_all(queries)
    assert counts.wait()
    spark.streams.removeListener(counts)
    stored = {r.batch_id: r["count"] for r in read_table(spark, path("pred")).groupBy("batch_id").count().collect()}
    alerts = {r.batch_id: r["count"] for r in read_table(spark, path("alerts")).groupBy("batch_id").count().collect()}
    assert [c["batch_id"] for c in reported] == list(range(len(reported))) and {c["query"] for c in reported} == {"counted"}
    assert sum(c["read"] for c in reported) == read_table(spark, topic, "text").count()
    for c in reported:
        assert c["scored"] == c["read"] - c["incomplete"] == stored.get(c["batch_id"], 0)
        assert c["critical"] == alerts.get(c["batch_id"], 0)


def test_counts_need_no_second_pass(spark, topic, model):
    """Observed counts sit in the one plan from message to prediction."""
    counts = BatchCounts()
    messages = read_table(spark, topic, "text")
    rows = score(streaming_scoring.decode_events(messages, counts=counts), model)
    text = plan(counts.observe(rows, "scored", scored_counts()))
    assert text.count("CollectMetrics") == 2 and "Exchange" not in text and "Python" not in text
    assert text.count("FileScan") == 1
