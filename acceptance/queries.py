"""Operators as queries: each takes a session and a data directory and reads whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.tables import (
    DEVIATION,
    LINE_FEATURES,
    LINE_KEYS,
    deviation,
    least_squares,
    published,
    rounded,
    signal,
    stream,
    table,
    training_rows,
)
from eventlake.functions.bands import RISK_SCORE, SEVERITY
from eventlake.functions.stamps import model_path, run_id
from eventlake.operators import scoring
from eventlake.operators.clean import drop_incomplete, to_double
from eventlake.operators.decode import accepted, decode_json, decode_or_reject, rejects
from eventlake.operators.metrics import regression_metrics
from eventlake.operators.physical import held, spread
from eventlake.operators.split import hash_part, random_part, random_split
from eventlake.plans import catalog, training
from eventlake.plans.registry import ModelRegistry
from eventlake.schemas import struct
from eventlake.session import work_path
from eventlake.sinks.publish import publish, to_messages
from eventlake.sinks.tables import append_table, replace_batches
from eventlake.sources.events import file_source, read_events
from eventlake.sources.tables import local_rows, read_csv, read_csv_by_header, read_table, read_widened
from eventlake.streaming.ingest import ingest, ingest_or_reject
from eventlake.streaming.paths import StreamPaths
from eventlake.streaming.progress import BatchCounts
from eventlake.streaming.replay import files_of_batches, replay_files
from eventlake.streaming.run import run_all
from eventlake.streaming.scoring import start_scoring

Query = Callable[[SparkSession, str], DataFrame]

ONCE = {"availableNow": True}
EVENT_TEXT = struct(event_id="long", user_id="long", event_type="string", value="double", ts="string")
PAYLOAD = struct(k="double")


def _event_columns(events: DataFrame) -> DataFrame:
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    return events.select("event_id", "user_id", "event_type", "value", moment)


# Decoding


def binary_to_text(spark, sf_dir):
    """PRJ1: a field's text out of a binary message"""
    messages = table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return decode_json(messages, struct(k="string"), keep=["event_id"]).withColumnRenamed("k", "text")


def parse_event_json(spark, sf_dir):
    """PRJ1, PRJ2, PRJ3"""
    messages = table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return decode_json(messages, PAYLOAD, keep=["event_id"])


def _dirty_messages(events: DataFrame) -> DataFrame:
    """A sixth each: no JSON, NaN, missing key, empty text, array; the rest as they are."""
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, F.lit('{"k": NaN}'))
        .when(kind == 2, F.lit('{"j": 1}'))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat(F.lit("["), "props", F.lit("]")))
        .otherwise(F.col("props"))
    )
    return events.select("event_id", value.alias("value"))


def _state(name: str):
    return F.when(F.col(name).isNull(), "null").when(F.isnan(name), "nan").otherwise("number")


def parse_dirty_json(spark, sf_dir):
    """PRJ2 on payloads that are no event"""
    parsed = decode_json(_dirty_messages(table(spark, sf_dir, "events")), PAYLOAD, keep=["event_id"])
    state = _state("k").alias("k_state")
    return parsed.select("event_id", state, F.when(~F.isnan("k"), F.col("k")).alias("k"))


def publish_round_trip(spark, sf_dir):
    """SNK6, PRJ2"""
    path = work_path(spark, "messages")
    publish(to_messages(_event_columns(table(spark, sf_dir, "events"))), "text", path)
    return decode_json(read_table(spark, path, "text"), EVENT_TEXT)


def csv_scan(spark, sf_dir):
    """SRC6: columns by the header's names, in another order and with one that is not wanted"""
    path = work_path(spark, "csv")
    events = _event_columns(table(spark, sf_dir, "events"))
    mixed = events.select("ts", F.lit("zz").alias("extra"), "value", "event_type", "event_id", "user_id")
    mixed.write.options(header=True, escape='"').csv(path)
    return read_csv(spark, path, EVENT_TEXT)


def csv_mixed_headers(spark, sf_dir):
    """SRC6: files of three headers in one directory, columns by each file's own; one lacks a column"""
    path = work_path(spark, "csv-mixed")
    events = _event_columns(table(spark, sf_dir, "events"))
    orders = [events.columns, list(reversed(events.columns)), [c for c in events.columns if c != "event_type"]]
    for part, columns in enumerate(orders):
        rows = events.where(F.col("event_id") % 3 == part).select(*columns)
        rows.write.mode("append").options(header=True, escape='"', compression="gzip" if part else "none").csv(path)
    return read_csv_by_header(spark, path, EVENT_TEXT, missing_as_null=True)


# Cleaning


def _gappy_events(spark, sf_dir):
    """Null values at every 7th and NaN at every 11th id; null type at every 13th."""
    event = F.col("event_id")
    value = F.when(event % 7 == 0, F.lit(None)).when(event % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    event_type = F.when(event % 13 != 0, F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id", value.cast("double").alias("value"), event_type.alias("event_type")
    )


def drop_incomplete_all(spark, sf_dir):
    """FLT1"""
    return drop_incomplete(_gappy_events(spark, sf_dir))


def drop_incomplete_subset(spark, sf_dir):
    """FLT2"""
    return drop_incomplete(_gappy_events(spark, sf_dir), ["value"])


def cast_features(spark, sf_dir):
    """PRJ7, PRJ4"""
    text = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return to_double(rows, ["value"], keep=["event_id"])


def row_count(spark, sf_dir):
    """AGG1"""
    return drop_incomplete(_gappy_events(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"))


# Bands


def _predicted(spark, sf_dir):
    """Tenth of an event's value as its predicted deviation"""
    predicted = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 10.0).alias("prediction"))
    return predicted.withColumnRenamed("prediction", scoring.PREDICTION_NAME)


def risk_bands(spark, sf_dir):
    """FN1, FN2, FN3, PRJ5, PRJ6, FLT4"""
    return scoring.with_risk(_predicted(spark, sf_dir))


def critical_alerts(spark, sf_dir):
    """FLT3, PRJ4, PRJ6"""
    return scoring.critical_alerts(scoring.with_risk(_predicted(spark, sf_dir)))


def threshold_filter(spark, sf_dir):
    """FLT4: the predictions of the severity that begins at a threshold"""
    high = scoring.with_risk(_predicted(spark, sf_dir)).where(F.col("severity") == "HIGH")
    return high.select("event_id", scoring.PREDICTION_NAME)


def run_ids(spark, sf_dir):
    """FN5, FN6"""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    stamped = events.select("event_id", "event_type", run_id(F.col("ts")).alias("run_id"))
    return stamped.withColumn("model_path", model_path("/models", F.col("event_type"), F.col("run_id")))


def local_relation(spark, sf_dir):
    """SRC7: a constant relation of response hours per severity, joined to every event"""
    hours = local_rows(spark, [("HIGH", 1), ("MEDIUM", 8), ("LOW", 72)], struct(severity="string", hours="long"))
    scores = RISK_SCORE.column(F.col(scoring.PREDICTION_NAME))
    banded = _predicted(spark, sf_dir).select("event_id", SEVERITY.column(scores).alias("severity"))
    return banded.join(hours, "severity")


# Metrics and choice


def _predictors(spark, sf_dir):
    """Three fixed predictors of the planted label"""
    return table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES).select(
        deviation().alias(DEVIATION),
        F.lit(8.0).alias("constant"),
        (F.col("l_quantity") * 0.3).alias("quantity"),
        signal().alias("signal"),
    )


def regression_quality(spark, sf_dir):
    """AGG1, AGG2, AGG3, AGG4"""
    measured = regression_metrics(_predictors(spark, sf_dir), DEVIATION, "signal")
    return measured.select("n", *[rounded(name, 6) for name in ("rmse", "mae", "r2")])


def _measured(spark, sf_dir):
    names = {"Constant": "constant", "Quantity": "quantity", "Signal": "signal", "SignalAgain": "signal"}
    return training.measure(_predictors(spark, sf_dir), names, DEVIATION)


def leaderboard(spark, sf_dir):
    """ML8, SRT1"""
    ranked = training.leaderboard(_measured(spark, sf_dir))
    return ranked.select("name", *[rounded(name, 6) for name in ("rmse", "mae", "r2")])


def best_by_rmse(spark, sf_dir):
    """AGG5; the tie between the two equal predictors goes to the earlier"""
    return training.best(_measured(spark, sf_dir)).select("name", rounded("rmse", 6))


# Training


def hash_split(spark, sf_dir):
    """ML2"""
    lines = table(spark, sf_dir, "lineitem", *LINE_KEYS)
    return lines.withColumn("part", hash_part(LINE_KEYS))


def random_split_whole(spark, sf_dir):
    """ML2: both parts together are the table, in the asked shares"""
    train, test = random_split(table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity"))
    both = train.withColumn("train", F.lit(1)).unionAll(test.withColumn("train", F.lit(0)))
    share = F.abs(F.avg("train") - 0.8) < 0.01
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("keys"),
        F.sum("l_quantity").alias("quantity"),
        share.alias("share_kept"),
    )


def assembled_features(spark, sf_dir):
    """ML1"""
    rows = training.assembler(LINE_FEATURES).transform(table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES))
    values = rows.withColumn("values", vector_to_array("features"))
    return values.select(*LINE_KEYS, *[F.col("values")[i].alias(f"feature_{i}") for i in range(len(LINE_FEATURES))])


def spread_and_hold(spark, sf_dir):
    """PHY1, PHY2"""
    rows = spread(table(spark, sf_dir, "events", "event_id", "value"), 8)
    with held(rows) as cached:
        n = cached.count()
    return rows.withColumn("n", F.lit(n).cast("bigint"))


def ols_coefficients(spark, sf_dir):
    """ML1, ML3, ML6"""
    model = least_squares(spark, sf_dir).stages[-1]
    terms = [("intercept", float(model.intercept)), *zip(LINE_FEATURES, map(float, model.coefficients))]
    return local_rows(spark, terms, struct(term="string", weight="double")).select("term", rounded("weight", 5))


def _split_table(spark, sf_dir):
    rows = training.model_columns(
        training_rows(spark, sf_dir), LINE_FEATURES, DEVIATION, part=hash_part(LINE_KEYS)
    )
    return training.write_training_table(rows)


def ols_test_predictions(spark, sf_dir):
    """ML2, ML3, ML6, ML7: fitted on the train part, applied to the test part"""
    parts = _split_table(spark, sf_dir)
    model = training.fit(parts.train, training.linear_regression(DEVIATION), LINE_FEATURES)
    return model.transform(parts.test).select(*LINE_FEATURES, rounded("prediction", 4))


def ols_leaderboard(spark, sf_dir):
    """ML7, ML8, AGG2-AGG4 of a fitted model on rows it has not seen"""
    parts = _split_table(spark, sf_dir)
    candidates = {"LinearRegression": training.linear_regression}
    models = training.fit_all(parts.train, LINE_FEATURES, DEVIATION, candidates)
    ranked = training.leaderboard(training.compare(parts.test, models, DEVIATION))
    return ranked.select("name", *[rounded(name, 5) for name in ("rmse", "mae", "r2")])


def model_leaderboard(spark, sf_dir):
    """ML2-ML8, AGG5, SRT1 with all candidates: the exact model of the planted signal comes first, all find it"""
    cores = spark.sparkContext.defaultParallelism  # the table is one small file; without a number one task would fit it all
    result = training.train(
        training_rows(spark, sf_dir), LINE_FEATURES, DEVIATION, part=hash_part(LINE_KEYS), partitions=cores
    )
    return result.leaderboard.select(
        "name", (F.col("name") == result.best_name).alias("is_best"), (F.col("r2") > 0.8).alias("finds_signal")
    )


def lot_split_table(spark, sf_dir):
    """ML2, FLT1, PRJ7: the training table of the split by lot; both parts together are the clean rows"""
    rows = training.model_columns(training_rows(spark, sf_dir), LINE_FEATURES, DEVIATION, part=random_part())
    parts = training.write_training_table(rows)
    return parts.train.unionAll(parts.test).select(*LINE_FEATURES, rounded(DEVIATION, 6))


def _stump_predictions(spark, sf_dir, estimator):
    rows = training_rows(spark, sf_dir).select(*LINE_FEATURES, DEVIATION)
    model = training.fit(rows, estimator, LINE_FEATURES)
    return model.transform(rows).select(*LINE_FEATURES, rounded("prediction", 4))


def forest_stump_predictions(spark, sf_dir):
    """ML4: one tree of one split over all rows and features, every midpoint a candidate"""
    stump = training.random_forest(
        DEVIATION, numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", maxBins=256
    )
    return _stump_predictions(spark, sf_dir, stump)


def boosted_stump_predictions(spark, sf_dir):
    """ML5: two rounds of one split each, the second on what the first leaves"""
    return _stump_predictions(spark, sf_dir, training.boosted_trees(DEVIATION, maxIter=2, maxDepth=1, maxBins=256))


def _published(spark, sf_dir):
    model = least_squares(spark, sf_dir)
    rmse = regression_metrics(model.transform(training_rows(spark, sf_dir)), DEVIATION).first().rmse
    registry = ModelRegistry(spark, work_path(spark, "models"))
    registry.publish(model, "LinearRegression", rmse)
    return registry


def model_pointer(spark, sf_dir):
    """SNK4, SNK5, PHY3, ML9"""
    pointer = _published(spark, sf_dir).latest()
    named = F.col("model_path").endswith(F.concat(F.lit("/LinearRegression_"), "timestamp"))
    return pointer.select("model_name", rounded("rmse", 5), named.alias("path_named_by_run"))


def published_if_better(spark, sf_dir):
    """SNK5, ML9: of three models in turn, the first and the better second are published, the worse third is not"""
    rows = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES, "l_returnflag")
    rows = rows.select("*", deviation().alias(DEVIATION))
    registry, outcomes = ModelRegistry(spark, work_path(spark, "models")), []
    for flags in (["R"], ["A", "N", "R"], ["A"]):
        chosen = rows.where(F.col("l_returnflag").isin(flags)).select(*LINE_FEATURES, DEVIATION)
        model = training.fit(chosen, training.linear_regression(DEVIATION), LINE_FEATURES)
        rmse = regression_metrics(model.transform(rows), DEVIATION).first().rmse
        outcome = registry.publish_if_better(model, "".join(flags), rmse)
        outcomes.append(("".join(flags), rmse, outcome.published, outcome.current.model_name))
    shape = struct(name="string", rmse="double", published="boolean", current="string")
    return local_rows(spark, outcomes, shape).select("name", rounded("rmse", 5), "published", "current")


def latest_model_scores(spark, sf_dir):
    """SRC8, ML7, PRJ5, PRJ6"""
    model = _published(spark, sf_dir).load()
    lines = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES)
    return _scores(scoring.score(lines, model, LINE_FEATURES, LINE_KEYS))


def _scores(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        *[F.col(name).cast("bigint").alias(name) for name in LINE_KEYS],
        *LINE_FEATURES,
        rounded(scoring.PREDICTION_NAME, 4),
        "risk_score",
        "severity",
        "risk_classification",
    )


# Streams


def _event_messages(spark, sf_dir):
    return published(spark, to_messages(_event_columns(table(spark, sf_dir, "events"))))


def _stream_paths(spark):
    base = work_path(spark, "stream")
    return StreamPaths(f"{base}/tables", f"{base}/checkpoints")


def _ingest_events(spark, messages, paths):
    followed = stream(spark, messages)
    run_all([ingest(followed, paths.output("events"), paths.checkpoint, EVENT_TEXT, trigger=ONCE)])


def stream_ingest(spark, sf_dir):
    """STR1, SNK1, SRC1, SRC2, SRC5"""
    paths = _stream_paths(spark)
    _ingest_events(spark, _event_messages(spark, sf_dir), paths)
    return read_table(spark, paths.output("events"))


def stream_ingest_malformed(spark, sf_dir):
    """STR1: malformed messages become rows of nulls"""
    paths = _stream_paths(spark)
    messages = published(spark, _dirty_messages(table(spark, sf_dir, "events")).select("value"))
    run_all([ingest(stream(spark, messages), paths.output("events"), paths.checkpoint, PAYLOAD, trigger=ONCE)])
    return read_table(spark, paths.output("events")).select(
        _state("k").alias("k_state"), F.when(~F.isnan("k"), F.col("k")).alias("k")
    )


def rejected_messages(spark, sf_dir):
    """PRJ2, STR1: messages and, with their text and kind, what is none, from one stream; together all that was sent"""
    paths = _stream_paths(spark)
    kind, props = F.col("event_id") % 8, F.col("props")
    value = (
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, F.lit('{"k": NaN}'))
        .when(kind == 2, F.lit('{"j": 1}'))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == 5, F.lit('{"k": "five"}'))
        .when(kind == 6, F.lit("  "))
        .otherwise(props)
    )
    messages = published(spark, table(spark, sf_dir, "events").select(value.alias("value")))
    tables = [paths.output("events"), paths.output("rejects")]
    run_all([ingest_or_reject(stream(spark, messages), *tables, paths.checkpoint, PAYLOAD, trigger=ONCE)])
    good, bad = (read_table(spark, path) for path in tables)
    return good.select(
        _state("k").alias("k_state"),
        F.when(~F.isnan("k"), F.col("k")).alias("k"),
        F.lit(None).cast("string").alias("text"),
        F.lit("message").alias("kind"),
    ).unionAll(bad.select(F.lit("null"), F.lit(None).cast("double"), "text", "kind"))


def stream_restart(spark, sf_dir):
    """STR2: a second run on the same checkpoint adds nothing"""
    paths, messages = _stream_paths(spark), _event_messages(spark, sf_dir)
    _ingest_events(spark, messages, paths)
    _ingest_events(spark, messages, paths)
    return read_table(spark, paths.output("events"))


def stream_reprocess(spark, sf_dir):
    """STR6: the next version holds the whole stream again, beside the first"""
    paths, messages = _stream_paths(spark), _event_messages(spark, sf_dir)
    _ingest_events(spark, messages, paths)
    again = paths.reprocess()
    _ingest_events(spark, messages, again)
    versions = [
        read_table(spark, each.output("events")).withColumn("version", F.lit(each.version).cast("bigint"))
        for each in (paths, again)
    ]
    return versions[0].unionAll(versions[1])


def _score_stream(spark, sf_dir):
    model = least_squares(spark, sf_dir)
    paths = _stream_paths(spark)
    messages = published(spark, to_messages(table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES)))
    outputs = [paths.output("predictions"), paths.output("alerts")]
    run_all(
        start_scoring(
            stream(spark, messages), model, *outputs, paths.checkpoint, LINE_FEATURES, LINE_KEYS, trigger=ONCE
        )
    )
    return outputs


def stream_score_predictions(spark, sf_dir):
    """STR3, STR4, FN1-FN3"""
    predictions, _ = _score_stream(spark, sf_dir)
    return _scores(read_table(spark, predictions))


def stream_score_alerts(spark, sf_dir):
    """STR3, STR4, FLT3"""
    _, alerts = _score_stream(spark, sf_dir)
    return _scores(read_table(spark, alerts))


def stream_fan_out_agreement(spark, sf_dir):
    """STR3, FN4: alerts are exactly the critical predictions, scoring time included"""
    predictions, alerts = (read_table(spark, path) for path in _score_stream(spark, sf_dir))
    columns = alerts.columns
    signed = (
        scoring.critical_alerts(predictions).select(*columns, F.lit(1).alias("sign"))
        .unionAll(alerts.select(*columns, F.lit(-1).alias("sign")))
    )
    unmatched = signed.groupBy(*columns).agg(F.sum("sign").alias("balance"), F.sum(F.abs("sign")).alias("copies"))
    return unmatched.agg(
        (F.sum("copies") / 2).cast("bigint").alias("n_alerts"),
        F.sum(F.abs("balance")).alias("n_unmatched"),
    )


def bounded_replay(spark, sf_dir):
    """STR6, STR2: of three batches the second is decoded again, by another rule, from a range of modification times"""
    paths, topic = _stream_paths(spark), work_path(spark, "messages")
    events = _event_columns(table(spark, sf_dir, "events"))
    good, bad = paths.output("events"), paths.output("rejects")
    moments = []
    for part in range(3):
        published(spark, to_messages(events.where(F.col("event_id") % 3 == part)), topic)
        run_all([ingest_or_reject(stream(spark, topic), good, bad, paths.checkpoint, EVENT_TEXT, trigger=ONCE)])
        files = files_of_batches(spark, paths.checkpoint).where(F.col("batch_id") == part)
        moments.append(files.agg(F.min("modified").alias("first"), F.max("modified").alias("last")).first())
    again = replay_files(spark, file_source(topic), paths.checkpoint, moments[1].first, moments[1].last)
    decoded = decode_or_reject(again.messages, EVENT_TEXT).withColumn("value", F.col("value") + 1000)
    replace_batches(accepted(decoded), good, again.batches)
    replace_batches(rejects(decoded), bad, again.batches)
    return read_table(spark, good).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def model_change_scores(spark, sf_dir):
    """SRC8, STR4: a model published while the stream runs scores the batches that follow, and only those"""
    paths, topic = _stream_paths(spark), work_path(spark, "messages")
    lines = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES)
    rows = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES, "l_returnflag")
    returned = rows.where("l_returnflag = 'R'").select(*LINE_FEATURES, deviation().alias(DEVIATION))
    with held(returned) as held_rows:  # fitting reads its input more than once
        of_returned = training.fit(held_rows, training.linear_regression(DEVIATION), LINE_FEATURES)
    registry, start = ModelRegistry(spark, work_path(spark, "models")), datetime(2024, 1, 1)
    registry.publish(least_squares(spark, sf_dir), "LinearRegression", 1.0, start)
    outputs = [paths.output("predictions"), paths.output("alerts")]
    published(spark, to_messages(lines.where("l_orderkey % 2 = 0")), topic)
    (query,) = start_scoring(stream(spark, topic), registry, *outputs, paths.checkpoint, LINE_FEATURES, LINE_KEYS)
    query.processAllAvailable()
    registry.publish(of_returned, "LinearRegression", 1.0, start + timedelta(days=1))
    published(spark, to_messages(lines.where("l_orderkey % 2 <> 0")), topic)
    query.processAllAvailable()
    query.stop()
    return _scores(read_table(spark, outputs[0]))


def batch_counts(spark, sf_dir):
    """STR5: what each batch read, dropped, scored and found critical, counted as its rows went by"""
    paths, topic = _stream_paths(spark), work_path(spark, "messages")
    lines = table(spark, sf_dir, "lineitem", *LINE_KEYS, *LINE_FEATURES)
    tax = F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax"))
    sent = to_messages(lines.withColumn("l_tax", tax))
    sent = sent.unionAll(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("value")))
    published(spark, sent, topic)
    reported: list[dict] = []
    counts = BatchCounts(reported.append)
    model = least_squares(spark, sf_dir)
    outputs = [paths.output("predictions"), paths.output("alerts")]
    followed = read_events(spark, file_source(topic, maxFilesPerTrigger="3"))
    run_all(start_scoring(followed, model, *outputs, paths.checkpoint, LINE_FEATURES, LINE_KEYS, trigger=ONCE, counts=counts))
    counts.wait()
    spark.streams.removeListener(counts)
    shape = struct(batch_id="long", read="long", incomplete="long", scored="long", critical="long")
    rows = local_rows(spark, [tuple(each[name] for name in shape.names) for each in reported], shape)
    stored = [
        read_table(spark, path).groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.count(F.lit(1)).alias(name))
        for path, name in zip(outputs, ("stored", "alerts"))
    ]
    # each batch's own counts against what it stored, then all batches together
    agree = F.coalesce("stored", F.lit(0)) == F.col("scored"), F.coalesce("alerts", F.lit(0)) == F.col("critical")
    met = rows.join(stored[0], "batch_id", "left").join(stored[1], "batch_id", "left")
    return met.agg(
        *[F.sum(name).alias(name) for name in shape.names[1:]],
        F.count(F.lit(1)).alias("batches"),
        F.bool_and(agree[0] & agree[1] & (F.col("read") == F.col("incomplete") + F.col("scored"))).alias("agree"),
    )


# Tables and SQL


def schema_evolution(spark, sf_dir):
    """SNK2, SRC5: rows appended before and after a column was added"""
    path = work_path(spark, "evolving")
    events = table(spark, sf_dir, "events")
    append_table(events.select("event_id", "value"), path)
    append_table(events.select("event_id", "value", "event_type"), path)
    return read_table(spark, path, merge_schema=True)


def stream_schema_evolution(spark, sf_dir):
    """SNK2, SNK1: a stream that starts to carry another column, on one path and checkpoint"""
    paths, topic = _stream_paths(spark), work_path(spark, "messages")
    events = to_messages(table(spark, sf_dir, "events").select("event_id", "value", "event_type"))
    for schema in (struct(event_id="long", value="double"), struct(event_id="long", value="double", event_type="string")):
        published(spark, events, topic)
        followed = stream(spark, topic)
        out = paths.output("events")
        run_all([ingest(followed, out, paths.checkpoint, schema, trigger=ONCE, merge_schema=True)])
    return read_table(spark, paths.output("events"), merge_schema=True)


def widened_column(spark, sf_dir):
    """SNK2, SRC5: a column that was a whole number first, then a double, then with a new one beside it"""
    path = work_path(spark, "widened")
    events = table(spark, sf_dir, "events")
    append_table(events.select("event_id", F.floor("value").cast("int").alias("value")), path)
    append_table(events.select("event_id", "value"), path)
    append_table(events.select("event_type", "value", "event_id"), path)
    return read_widened(spark, path)


def _registered(spark, sf_dir, *names):
    """The tables under names of their own per data directory"""
    schema = f"eventlake_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}"
    catalog.create_schema(spark, schema)
    for name in names:
        catalog.register(spark, f"{schema}.{name}", f"{sf_dir}/{name}.parquet")
    return schema


def registered_table(spark, sf_dir):
    """CAT1, CAT2, CAT3, PRJ8"""
    schema = _registered(spark, sf_dir, "orders")
    orders = catalog.query(spark, f"SELECT * FROM {schema}.orders")
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def registered_table_limit(spark, sf_dir):
    """CAT1, CAT2, CAT3, LIM1; ordered, so that the ten rows are the same everywhere"""
    schema = _registered(spark, sf_dir, "events")
    return catalog.query(spark, f"SELECT event_id, event_type, value FROM {schema}.events ORDER BY event_id LIMIT 10")


def registered_predictions(spark, sf_dir):
    """CAT2, CAT3 over a table that a scoring stream wrote batch by batch"""
    predictions, _ = _score_stream(spark, sf_dir)
    name = f"eventlake_streams.predictions_{hashlib.md5(predictions.encode()).hexdigest()[:8]}"
    catalog.create_schema(spark, "eventlake_streams")
    catalog.register(spark, name, predictions)
    return catalog.query(spark, f"SELECT severity, count(*) AS n FROM {name} GROUP BY severity")


def parameterised_sql(spark, sf_dir):
    """CAT4, LIM1: values and a limit bound by name; ordered, so that the rows are the same everywhere"""
    schema = _registered(spark, sf_dir, "events")
    text = f"""
        SELECT event_id, value FROM {schema}.events
        WHERE event_type = :kind AND value >= :least ORDER BY event_id LIMIT :n"""
    return catalog.query(spark, text, kind="error", least=50.0, n=100_000_000)


def named_sql(spark, sf_dir):
    """CAT4: table and column by name, values as a list"""
    schema = _registered(spark, sf_dir, "events")
    text = "SELECT event_id, IDENTIFIER(:shown) AS shown FROM IDENTIFIER(:source) WHERE array_contains(:kinds, event_type)"
    return catalog.query(spark, text, shown="value", source=f"{schema}.events", kinds=["error", "click"])


def rebalanced_append(spark, sf_dir):
    """PHY1, SNK1: a partitioned table whose files the engine sizes holds the same rows"""
    path = work_path(spark, "rebalanced")
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    append_table(events, path, partition_by=["event_type"], rebalance=True)
    return read_table(spark, path)


def sql_join(spark, sf_dir):
    """CAT3: both sides are counted per key before the join, so a key of many rows meets as one row"""
    schema = _registered(spark, sf_dir, "orders", "lineitem")
    return catalog.query(
        spark,
        f"""
        SELECT o_orderpriority, sum(orders * lines) AS n_lines, sum(orders * quantity) AS quantity
        FROM (
            SELECT o_orderkey, o_orderpriority, count(*) AS orders
            FROM {schema}.orders GROUP BY o_orderkey, o_orderpriority
        )
        JOIN (
            SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity
            FROM {schema}.lineitem GROUP BY l_orderkey
        ) ON l_orderkey = o_orderkey
        GROUP BY o_orderpriority
        """,
    )


def finished_tables_join(spark, sf_dir):
    """CAT2, CAT3: a join over tables with column statistics, its order left to the optimizer"""
    schema = f"eventlake_finished_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}"
    catalog.create_schema(spark, schema)
    for name in ("lineitem", "orders", "customer", "nation"):
        catalog.register_finished(spark, f"{schema}.{name}", f"{sf_dir}/{name}.parquet")
    text = f"""
        SELECT n_name, count(*) AS n_lines, sum(l_quantity) AS quantity
        FROM {schema}.lineitem JOIN {schema}.orders ON l_orderkey = o_orderkey
        JOIN {schema}.customer ON o_custkey = c_custkey JOIN {schema}.nation ON c_nationkey = n_nationkey
        WHERE n_nationkey < 5 GROUP BY n_name"""
    with catalog.by_cost(spark):
        result = catalog.query(spark, text)
        rows = result.collect()  # five at most
    return local_rows(spark, [tuple(row) for row in rows], result.schema)


def sql_group_by(spark, sf_dir):
    """CAT3"""
    schema = _registered(spark, sf_dir, "lineitem")
    return catalog.query(
        spark,
        f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity
        FROM {schema}.lineitem GROUP BY l_returnflag, l_linestatus
        """,
    )


def sql_window(spark, sf_dir):
    """CAT3: each customer's latest order; the rank filter also runs ahead of the shuffle"""
    schema = _registered(spark, sf_dir, "orders")
    return catalog.query(
        spark,
        f"""
        SELECT o_custkey, o_orderkey, o_totalprice FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
            FROM {schema}.orders
        ) WHERE place = 1
        """,
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        binary_to_text,
        parse_event_json,
        parse_dirty_json,
        publish_round_trip,
        csv_scan,
        csv_mixed_headers,
        drop_incomplete_all,
        drop_incomplete_subset,
        cast_features,
        row_count,
        risk_bands,
        critical_alerts,
        threshold_filter,
        run_ids,
        local_relation,
        regression_quality,
        leaderboard,
        best_by_rmse,
        hash_split,
        random_split_whole,
        assembled_features,
        spread_and_hold,
        ols_coefficients,
        ols_test_predictions,
        ols_leaderboard,
        model_leaderboard,
        lot_split_table,
        forest_stump_predictions,
        boosted_stump_predictions,
        model_pointer,
        published_if_better,
        latest_model_scores,
        stream_ingest,
        stream_ingest_malformed,
        rejected_messages,
        stream_restart,
        stream_reprocess,
        stream_score_predictions,
        stream_score_alerts,
        stream_fan_out_agreement,
        bounded_replay,
        model_change_scores,
        batch_counts,
        schema_evolution,
        stream_schema_evolution,
        widened_column,
        registered_table,
        registered_table_limit,
        registered_predictions,
        parameterised_sql,
        named_sql,
        rebalanced_append,
        sql_join,
        finished_tables_join,
        sql_group_by,
        sql_window,
    )
}
