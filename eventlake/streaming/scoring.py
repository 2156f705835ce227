"""One scoring stream, two tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.clean import drop_incomplete
from eventlake.operators.decode import decode_json
from eventlake.operators.scoring import critical_alerts, score
from eventlake.schemas import FEATURES, scoring_schema
from eventlake.plans.registry import ModelRegistry
from eventlake.sinks.tables import compacted_to, read_batch, require_typed, write_batch
from eventlake.sources.paths import create_once, read_text, remove
from eventlake.streaming.ingest import console
from eventlake.streaming.paths import require_paired
from eventlake.streaming.progress import READ, SCORED, BatchCounts, read_counts, scored_counts

#: Batches whose model stays on record; a stream tries its last one again.
MODELS_KEPT = 100


def decode_events(
    messages: DataFrame,
    features: Iterable[str] = FEATURES,
    keys: Iterable[str] = ("timestamp",),
    value: str = "value",
    counts: BatchCounts | None = None,
) -> DataFrame:
    """Messages down to what scoring needs, complete ones only [FLT2]; ``counts`` learns how many there were of each kind."""
    features = list(features)
    decoded = decode_json(messages, scoring_schema(features, keys), value)
    if counts is not None:
        decoded = counts.observe(decoded, READ, read_counts(features))
    return drop_incomplete(decoded, features)


def fan_out(
    predictions: DataFrame,
    predictions_path: str,
    alerts_path: str,
    checkpoint: str,
    format: str = "parquet",
    trigger: dict | None = None,
    name: str = "scoring",
    score_batch: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Predictions and their alerts from one read of the stream and one prediction per event [STR3].

    Each micro-batch commits its predictions, then filters its alerts from that
    committed partition. So both tables agree in rows and scoring time, a retry
    replaces what it left half done, and losing executors or cached blocks in
    between repeats no prediction. A backlog's batch stays bounded by the
    source's ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``. A file table
    gains a directory a batch: space batches by the ``trigger``, and fold old
    ones with :func:`eventlake.sinks.tables.compact`. Formats that do not store
    their columns' types are refused. With ``score_batch`` the stream's rows
    become predictions only there, batch by batch.
    """
    require_typed(format)
    require_paired(predictions.sparkSession, checkpoint, predictions_path, alerts_path)

    def write_both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if format != "delta" and batch_id <= max(compacted_to(spark, path) for path in (predictions_path, alerts_path)):
            return  # both tables have it, together with others
        rows = batch if score_batch is None else score_batch(batch, batch_id)
        write_batch(rows, predictions_path, batch_id, format, f"{name}-predictions:{checkpoint}")
        committed = read_batch(spark, predictions_path, batch_id, format, rows.schema)
        write_batch(critical_alerts(committed), alerts_path, batch_id, format, f"{name}-alerts:{checkpoint}")

    writer = (
        predictions.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_both)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def model_of_batch(registry: ModelRegistry, checkpoint: str, batch_id: int) -> str:
    """Path of the model that scores a batch [SRC8]: the one on record for it, or the latest, which is then recorded.

    The record lies with the checkpoint and is made before the batch is scored,
    so a retry takes the same model whatever has been published since.
    """
    records = f"{checkpoint}/models"
    path = read_text(registry.spark, f"{records}/{batch_id}")
    if path is None:
        create_once(registry.spark, f"{records}/{batch_id}", registry.resolve())
        path = read_text(registry.spark, f"{records}/{batch_id}")
        remove(registry.spark, f"{records}/{batch_id - MODELS_KEPT}")
    return path


def start_scoring(
    messages: DataFrame,
    model: PipelineModel | ModelRegistry,
    predictions_path: str,
    alerts_path: str,
    checkpoint: str,
    features: Iterable[str] = FEATURES,
    keys: Iterable[str] = ("timestamp",),
    value: str = "value",
    debug: bool = False,
    counts: BatchCounts | None = None,
    name: str = "scoring",
    **options,
) -> list[StreamingQuery]:
    """Decode, score and write a message stream [STR3, STR4]; ``debug`` also prints the events [SNK3].

    A :class:`ModelRegistry` instead of a model means its latest one, looked up
    for each micro-batch: one published meanwhile scores the next batch, and no
    restart is needed. ``counts``, added to the session's stream listeners here,
    reports each batch's messages, incomplete ones, predictions and critical ones.
    """
    spark, features, keys = messages.sparkSession, list(features), list(keys)
    if counts is not None:
        spark.streams.addListener(counts)
    events = decode_events(messages, features, keys, value, counts)
    loaded: dict[str, PipelineModel] = {}

    def score_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        path = model_of_batch(model, checkpoint, batch_id)
        if path not in loaded:
            loaded.clear()
            loaded[path] = model.load(path)
        rows = score(batch, loaded[path], features, keys)
        if counts is None:
            return rows
        observation = Observation(SCORED)
        counts.add(name, batch_id, observation)
        return rows.observe(observation, *scored_counts())

    if isinstance(model, ModelRegistry):
        rows, own = events, score_batch
    else:
        rows, own = score(events, model, features, keys), None
        rows = rows if counts is None else counts.observe(rows, SCORED, scored_counts())
    queries = [fan_out(rows, predictions_path, alerts_path, checkpoint, name=name, score_batch=own, **options)]
    if debug:
        queries.append(console(decode_events(messages, features, keys, value), options.get("trigger"), f"{name}-debug"))
    return queries
