"""Split, fit, compare, choose."""

import math

import numpy as np
import pytest
from conftest import multiset, plan
from pyspark.sql import functions as F

from eventlake.operators.physical import held, spread
from eventlake.operators.scoring import critical_alerts, score
from eventlake.operators.split import hash_part, random_part, random_split
from eventlake.plans import training
from eventlake.schemas import FEATURES, LABEL, LEADERBOARD, PREDICTION
from eventlake.sources.paths import exists


@pytest.fixture(scope="module")
def result(spark, events):
    return training.train(events, part=hash_part(["timestamp"]))


def test_parts_are_the_whole_table(spark, events):
    for part in (hash_part(["timestamp"]), random_part()):
        table = training.write_training_table(training.model_columns(events, part=part))
        assert table.count() == 2000
        assert multiset(table.train.unionAll(table.test)) == multiset(training.model_columns(events))
        assert table.train.count() / 2000 == pytest.approx(0.8, abs=0.04)


def test_hash_part_ignores_the_layout(spark, events):
    part = events.withColumn("part", hash_part(["timestamp"])).select("timestamp", "part")
    other = events.repartition(7).orderBy("lead_time_days").withColumn("part", hash_part(["timestamp"]))
    assert multiset(part) == multiset(other.select("timestamp", "part"))


def test_random_split_repeats_itself(spark, events):
    first, second = random_split(events)
    again, _ = random_split(events)
    assert multiset(first) == multiset(again)
    assert first.count() + second.count() == 2000


def test_required_columns(spark, events):
    status = F.when(F.col("timestamp") == "t1", None).otherwise("ok")
    gappy = events.withColumn("cargo_condition_status", status)
    assert training.model_columns(gappy).count() == 1999
    pruned = training.model_columns(gappy, required=[*FEATURES, LABEL])
    assert pruned.count() == 2000
    assert pruned.columns == [*FEATURES, LABEL]


def test_parts_are_pruned_scans(spark, result):
    text = plan(result.table.test)
    assert "(part#" in text and "= test)" in text and "PartitionFilters: [isnotnull" in text


def test_leaderboard(result):
    rows = result.leaderboard.collect()
    assert result.leaderboard.dtypes == [(f.name, f.dataType.simpleString()) for f in LEADERBOARD]
    assert sorted(row.name for row in rows) == ["GBT", "LinearRegression", "RandomForest"]
    assert [row.rmse for row in rows] == sorted(row.rmse for row in rows)
    assert all(math.isfinite(value) for row in rows for value in tuple(row)[1:])
    assert all(row.r2 > 0 for row in rows)
    assert (result.best_name, result.best_rmse) == ("LinearRegression", rows[0].rmse)


def test_leaderboard_by_brute_force(result):
    """Ensembles put together from their own trees, metrics worked out in numpy."""
    for name, model in result.models.items():
        rows = model.transform(result.table.test).collect()
        label = np.array([row[LABEL] for row in rows])
        regressor = model.stages[-1]
        if name == "LinearRegression":
            vectors = np.array([row.features.toArray() for row in rows])
            prediction = vectors @ regressor.coefficients.toArray() + regressor.intercept
        else:
            weights = np.array(regressor.treeWeights) / (
                sum(regressor.treeWeights) if name == "RandomForest" else 1.0
            )
            trees = regressor.trees
            prediction = np.array(
                [sum(w * tree.predict(row.features) for w, tree in zip(weights, trees)) for row in rows[:100]]
            )
            assert prediction == pytest.approx(np.array([row.prediction for row in rows[:100]]))
            prediction = np.array([row.prediction for row in rows])
        row = result.leaderboard.where(F.col("name") == name).first()
        assert row.rmse == pytest.approx(np.sqrt(np.mean((label - prediction) ** 2)))
        assert row.mae == pytest.approx(np.mean(np.abs(label - prediction)))
        assert row.r2 == pytest.approx(1 - np.sum((label - prediction) ** 2) / np.sum((label - label.mean()) ** 2))


def test_least_squares_by_brute_force(result):
    rows = np.array(result.table.train.collect())
    solution, *_ = np.linalg.lstsq(np.c_[rows[:, :-1], np.ones(len(rows))], rows[:, -1], rcond=None)
    model = result.models["LinearRegression"].stages[-1]
    assert model.coefficients.toArray() == pytest.approx(solution[:-1])
    assert model.intercept == pytest.approx(solution[-1])


def test_candidate_parameters(result):
    forest, boosted = result.models["RandomForest"].stages[-1], result.models["GBT"].stages[-1]
    assert (forest.getNumTrees, forest.getMaxDepth(), forest.getSeed()) == (40, 8, 42)
    assert (boosted.getNumTrees, boosted.getMaxDepth(), boosted.getSeed()) == (40, 5, 42)
    linear = result.models["LinearRegression"].stages[-1]
    assert (linear.getMaxIter(), linear.getRegParam()) == (50, 0.0)


def test_training_repeats_itself_on_its_table(result):
    candidates = {"RandomForest": training.random_forest}
    again = training.fit_all(result.table.train, candidates=candidates)
    first, second = (
        training.compare(result.table.test, models).where("name = 'RandomForest'").first().rmse
        for models in (result.models, again)
    )
    assert first == second


def test_cached_training_gives_the_same_model(spark, events):
    candidates = {"LinearRegression": training.linear_regression}
    runs = [
        training.train(events, part=hash_part(["timestamp"]), candidates=candidates, cache=cache)
        for cache in (False, True)
    ]
    assert runs[0].best_rmse == pytest.approx(runs[1].best_rmse)
    assert not runs[1].table.train.is_cached


def test_no_test_rows_is_an_error(spark, events):
    candidates = {"LinearRegression": training.linear_regression}
    with pytest.raises(ValueError, match="usable RMSE"):
        training.train(events, part=F.lit("train"), candidates=candidates)


def test_incomplete_vectors_are_errors(spark):
    rows = spark.createDataFrame([(None,)], "x DOUBLE")
    with pytest.raises(Exception, match="null"):
        training.assembler(["x"]).transform(rows).collect()


def test_prediction_columns(spark, events, result):
    predictions = score(events, result.best_model)
    assert predictions.columns == PREDICTION.names
    assert [f.dataType for f in predictions.schema] == [f.dataType for f in PREDICTION]
    assert predictions.count() == 2000


def test_scoring_keeps_null_timestamps_and_drops_incomplete_features(spark, events, result):
    gappy = events.withColumn("timestamp", F.lit(None).cast("string")).withColumn(
        "iot_temperature", F.when(F.col("iot_temperature") < 5, float("nan")).otherwise(F.col("iot_temperature"))
    )
    expected = events.where("iot_temperature >= 5").count()
    assert 0 < expected < 2000
    assert score(gappy, result.best_model).where("timestamp IS NULL").count() == expected


def test_model_runs_once_per_row_under_an_alert_filter(spark, events, result):
    text = plan(critical_alerts(score(events, result.models["RandomForest"])))
    assert text.count("UDF(features") == 1
    assert "Exchange" not in text and "Python" not in text


def test_spread(spark):
    assert spread(spark.range(10), 3).rdd.getNumPartitions() == 3
    assert "RoundRobin" in plan(spread(spark.range(0, 1 << 40, 1, 2), 3))


def test_held_rows_are_released(spark):
    rows = spark.range(10)
    with held(rows) as cached:
        assert cached.is_cached and cached.count() == 10
        assert cached.storageLevel.useDisk and cached.storageLevel.useMemory
    assert not rows.is_cached


def written_plan(spark):
    """The plan of the last write."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    return [text for text in plans if "InsertIntoHadoopFsRelationCommand" in text][-1]


@pytest.mark.parametrize("split_bytes", ["1m", "1g"])
def test_the_training_table_is_written_without_sort_or_shuffle(spark, events, split_bytes):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        table = training.write_training_table(training.model_columns(events, part=hash_part(["timestamp"])))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    text = written_plan(spark)
    assert "Sort" not in text and "Exchange" not in text
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert table.count() == 2000


def test_a_stated_number_of_partitions_spreads(spark, events):
    rows = training.model_columns(events, part=hash_part(["timestamp"]))
    table = training.write_training_table(rows, partitions=3)
    assert "Exchange" in written_plan(spark) and sum("/part=train/" in f for f in table.train.inputFiles()) == 3


def test_a_training_table_can_be_dropped(spark, events):
    table = training.write_training_table(training.model_columns(events, part=hash_part(["timestamp"])))
    table.drop()
    assert not exists(spark, table.path)


def test_models_over_the_same_features_share_one_vector(spark, events):
    candidates = {"a": training.linear_regression, "b": training.linear_regression}
    models = training.fit_all(events, candidates=candidates)
    assert plan(training.compare(events, models)).count("UDF(struct(") <= 3
    measured = training.compare(events, models).collect()
    assert [r.name for r in measured] == ["a", "b"] and measured[0].rmse == measured[1].rmse
    other = {"a": models["a"], "c": training.fit(events, training.linear_regression(), FEATURES[:3])}
    assert training.compare(events, other).count() == 2
