"""A third of all rows are copies of one event; none may be lost, merged or moved to one task."""

import pytest
from conftest import multiset, plan
from pyspark.sql import functions as F

from eventlake.operators.metrics import regression_metrics
from eventlake.operators.scoring import critical_alerts, score
from eventlake.operators.split import PART, hash_part, random_part
from eventlake.plans import training
from eventlake.schemas import LABEL, struct
from eventlake.sinks.publish import publish, to_messages
from eventlake.sources.events import file_source, read_events
from eventlake.sources.tables import local_rows, read_table
from eventlake.streaming.run import run_all
from eventlake.streaming.scoring import decode_events, start_scoring


@pytest.fixture(scope="module")
def skewed(spark, events, tmp_path_factory):
    table = str(tmp_path_factory.mktemp("skewed") / "table")
    hot = events.where("timestamp = 't7'").select("*", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("n"))
    events.unionAll(hot.drop("n")).write.parquet(table)
    return spark.read.parquet(table)


@pytest.fixture(scope="module")
def model(events):
    return training.fit(events, training.linear_regression())


def test_lots_divide_copies(skewed):
    table = training.write_training_table(training.model_columns(skewed, part=random_part()))
    assert table.count() == 3000
    copies = training.model_columns(skewed.where("timestamp = 't7'")).first()
    in_train, in_test = (
        part.where(F.col(LABEL) == copies[LABEL]).count() for part in (table.train, table.test)
    )
    assert in_train + in_test >= 1001
    assert in_train / (in_train + in_test) == pytest.approx(0.8, abs=0.05)


def test_hash_parts_keep_copies_together_and_whole(skewed):
    parts = skewed.withColumn(PART, hash_part(["timestamp"])).groupBy("timestamp").agg(
        F.countDistinct(PART).alias("parts"), F.count(F.lit(1)).alias("n")
    )
    assert {row.parts for row in parts.collect()} == {1}
    assert parts.agg(F.sum("n").alias("n")).first().n == 3000
    table = training.write_training_table(training.model_columns(skewed, part=hash_part(["timestamp"])))
    assert table.count() == 3000


def test_metrics_weigh_every_copy(skewed):
    rows = skewed.select(LABEL, F.lit(1.0).alias("prediction"))
    labels = [row[LABEL] for row in rows.collect()]
    measured = regression_metrics(rows, LABEL).first()
    assert measured.n == 3000
    assert measured.mae == pytest.approx(sum(abs(y - 1.0) for y in labels) / 3000)


def test_streams_keep_every_copy(spark, skewed, model, path):
    publish(to_messages(skewed), "text", path("topic"))
    messages = read_events(spark, file_source(path("topic")))
    run_all(start_scoring(messages, model, path("pred"), path("alerts"), path("cp"), trigger={"availableNow": True}))
    predictions, alerts = (read_table(spark, path(name)).drop("batch_id") for name in ("pred", "alerts"))
    assert predictions.where("timestamp = 't7'").count() == 1001
    assert multiset(alerts) == multiset(critical_alerts(predictions))
    batch = score(decode_events(read_table(spark, path("topic"), "text")), model)
    assert multiset(predictions.drop("scoring_time")) == multiset(batch.drop("scoring_time"))


def test_a_join_with_driver_rows_leaves_the_table_in_place(spark, skewed):
    names = local_rows(spark, [("t7", "hot"), ("t8", "cold")], struct(timestamp="string", name="string"))
    joined = skewed.join(names, "timestamp")
    assert "Exchange hashpartitioning" not in plan(joined)
    assert joined.where("name = 'hot'").count() == 1001
