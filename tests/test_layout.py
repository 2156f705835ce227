"""Files and partitions of a good size."""

import pytest
from conftest import multiset, plan
from pyspark.sql import functions as F

from eventlake.operators.physical import rebalanced
from eventlake.operators.split import random_part
from eventlake.plans.training import model_columns, write_training_table
from eventlake.sinks.tables import append_table
from eventlake.sources.tables import read_table


@pytest.fixture
def advised(spark):
    """Partitions of 64 kB at most."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "64k")
    yield
    spark.conf.unset(name)


def test_a_hot_value_is_split_and_small_ones_are_merged(spark, path, advised):
    hot = F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 5).cast("string")))
    rows = spark.range(0, 200_000, 1, 16).select(F.rand(1).alias("x"), hot.alias("kind"))
    append_table(rows, path("plain"), partition_by=["kind"])
    append_table(rows, path("sized"), partition_by=["kind"], rebalance=True)
    plain, sized = read_table(spark, path("plain")), read_table(spark, path("sized"))
    assert multiset(sized.groupBy("kind").agg(F.count("*"), F.max("x"))) == multiset(plain.groupBy("kind").agg(F.count("*"), F.max("x")))
    files = {r.kind: r.n for r in sized.groupBy("kind").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    before = {r.kind: r.n for r in plain.groupBy("kind").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files["hot"] > 3 and all(files[kind] < before[kind] for kind in files if kind != "hot")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(rebalanced(rows, ["kind"])) and "REBALANCE_PARTITIONS_BY_NONE" in plan(rebalanced(rows))


def test_training_tables(spark, events, path, advised):
    rows = model_columns(events, part=random_part())
    table = write_training_table(rows, path("t"), rebalance=True)
    assert table.count() == 2000 and table.train.inputFiles()
    with pytest.raises(ValueError):
        write_training_table(rows, path("u"), 4, rebalance=True)
