import pytest
from conftest import multiset
from pyspark.sql import functions as F

from eventlake.plans import catalog
from eventlake.sinks.tables import append_table, write_batch


def test_register_and_query(spark, path):
    append_table(spark.range(20).selectExpr("id", "id % 3 AS kind"), path("t"))
    catalog.create_schema(spark, "lake_a")
    catalog.create_schema(spark, "lake_a")
    catalog.register(spark, "lake_a.t", path("t"))
    assert catalog.query(spark, "SELECT * FROM lake_a.t").count() == 20
    assert catalog.query(spark, "SELECT * FROM lake_a.t LIMIT 10").count() == 10
    assert catalog.query(spark, "SELECT id FROM lake_a.t WHERE kind = :kind LIMIT :n", kind=1, n=3).count() == 3


def test_values_are_bound_not_pasted(spark, path):
    append_table(spark.createDataFrame([("a",), ("' OR 1=1 --",)], "s STRING"), path("t"))
    catalog.create_schema(spark, "lake_b")
    catalog.register(spark, "lake_b.t", path("t"))
    text = "SELECT * FROM lake_b.t WHERE s = :s"
    assert catalog.query(spark, text, s="' OR 1=1 --").count() == 1


def test_registering_again(spark, path):
    append_table(spark.range(5).toDF("id"), path("t"))
    append_table(spark.range(5).toDF("id"), path("other"))
    catalog.create_schema(spark, "lake_c")
    catalog.register(spark, "lake_c.t", path("t"))
    append_table(spark.range(5).toDF("id"), path("t"))
    catalog.register(spark, "lake_c.t", path("t"))
    assert catalog.query(spark, "SELECT count(*) AS n FROM lake_c.t").first().n == 10
    with pytest.raises(ValueError, match="is registered at"):
        catalog.register(spark, "lake_c.t", path("other"))


def test_batch_partitions_appear_when_registered_again(spark, path):
    write_batch(spark.range(5).toDF("id"), path("t"), 0)
    catalog.create_schema(spark, "lake_d")
    catalog.register(spark, "lake_d.t", path("t"))
    assert catalog.query(spark, "SELECT * FROM lake_d.t").count() == 5
    write_batch(spark.range(7).toDF("id"), path("t"), 1)
    catalog.register(spark, "lake_d.t", path("t"))
    counts = catalog.query(spark, "SELECT batch_id, count(*) AS n FROM lake_d.t GROUP BY batch_id")
    assert multiset(counts) == ["Row(batch_id=0, n=5)", "Row(batch_id=1, n=7)"]


def test_later_batches_are_seen_without_another_registration(spark, path):
    write_batch(spark.range(5).toDF("id"), path("t"), 0)
    catalog.create_schema(spark, "lake_e")
    catalog.register(spark, "lake_e.t", path("t"))
    assert catalog.query(spark, "SELECT * FROM lake_e.t").count() == 5
    write_batch(spark.range(7).toDF("id"), path("t"), 1)
    assert catalog.query(spark, "SELECT count(*) AS n FROM lake_e.t").first().n == 12
    append_table(spark.range(3).toDF("id"), path("plain"))
    catalog.register(spark, "lake_e.plain", path("plain"))
    assert catalog.query(spark, "SELECT * FROM lake_e.plain").count() == 3
    append_table(spark.range(4).toDF("id"), path("plain"))
    assert catalog.query(spark, "SELECT * FROM lake_e.plain").count() == 7


def test_reserved_words_are_names(spark, path):
    append_table(spark.range(2).toDF("id"), path("t"))
    catalog.create_schema(spark, "select")
    catalog.register(spark, "select.t", path("t"))
    assert catalog.location(spark, "select.t").endswith("/t")


@pytest.fixture
def star(spark, path):
    """A large table, one of its size in rows but not in distinct keys, and a small one; all finished."""
    facts = spark.range(20_000).select((F.col("id") % 5000).alias("a"), (F.col("id") % 50).alias("b"), F.col("id").alias("x"))
    facts.write.parquet(path("facts"))
    spark.range(20_000).select((F.col("id") % 5000).alias("a"), F.col("id").alias("y")).write.parquet(path("wide"))
    spark.range(3).select(F.col("id").alias("b"), F.lit("z").alias("name")).write.parquet(path("small"))
    schema = f"star_{abs(hash(path('x')))}"
    catalog.create_schema(spark, schema)
    for name in ("facts", "wide", "small"):
        catalog.register_finished(spark, f"{schema}.{name}", path(name))
    return schema


def test_joins_follow_statistics(spark, star):
    """The join that keeps few rows comes first, whatever the order it is written in."""
    text = f"SELECT x, y, name FROM {star}.facts JOIN {star}.wide USING (a) JOIN {star}.small USING (b)"

    def first_join(frame):
        """Names of the two tables that meet first: the deepest join of the plan."""
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return [next(name for name in ("facts", "wide", "small") if f".{name}" in line) for line in lines if "Relation" in line]

    as_written = catalog.query(spark, text)
    with catalog.by_cost(spark):
        by_cost = catalog.query(spark, text)
        order = first_join(by_cost)
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    assert first_join(as_written) == ["facts", "wide", "small"] and order.index("wide") in (0, 2) and order != ["facts", "wide", "small"]
    assert multiset(by_cost) == multiset(as_written)


def test_finished_tables_have_statistics(spark, path, star):
    stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {star}.facts b").collect()}
    assert abs(int(stats["distinct_count"]) - 50) <= 5 and stats["max"] == "49" and stats["num_nulls"] == "0"
    parted = spark.range(30).select("id", (F.col("id") % 3).alias("p"))
    parted.write.partitionBy("p").parquet(path("parted"))
    for _ in range(2):
        catalog.register_finished(spark, f"{star}.parted", path("parted"), columns=["id"])
    assert spark.table(f"{star}.parted").where("p = 1").count() == 10
    with pytest.raises(ValueError, match="registered at"):
        catalog.register_finished(spark, f"{star}.parted", path("facts"))
    catalog.register(spark, f"{star}.growing", path("facts"))
    with pytest.raises(ValueError, match="view"):
        catalog.register_finished(spark, f"{star}.growing", path("facts"))
