import gzip
from pathlib import Path

import pytest
from conftest import multiset, plan
from pyspark.errors import AnalysisException

from eventlake.operators.clean import drop_incomplete
from eventlake.schemas import EVENT, FEATURES, LABEL, PREDICTION, SCORE_EVENT, struct
from eventlake.sinks.tables import append_table
from eventlake.sources.events import file_source, kafka_source, read_events
from eventlake.sources.paths import first_lines
from eventlake.sources.tables import WRITE, local_rows, read_csv, read_csv_by_header, read_table, read_widened


def test_schemas():
    assert len(EVENT) == 15 and len(SCORE_EVENT) == 11 and len(FEATURES) == 10 and len(PREDICTION) == 16
    assert set(FEATURES) < set(EVENT.names) and LABEL in EVENT.names
    assert all(field.nullable for field in EVENT)


def test_kafka_options(spark):
    source = kafka_source("a:1,b:2", "events", "earliest", False, "PLAINTEXT", maxOffsetsPerTrigger="1000")
    assert source.format == "kafka"
    assert source.options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "PLAINTEXT",
        "maxOffsetsPerTrigger": "1000",
    }
    assert set(kafka_source("a:1", "events").options) == {"kafka.bootstrap.servers", "subscribe", "startingOffsets"}
    with pytest.raises(AnalysisException, match="kafka"):
        read_events(spark, source)  # the connector's jar is not installed here


def test_file_policies():
    with pytest.raises(ValueError, match="all its files"):
        file_source("/x", starting_offsets="latest")
    assert file_source("/x").options == {}
    assert file_source("/x", fail_on_data_loss=False).options == {"ignoreMissingFiles": "true"}


def test_text_stream(spark, path):
    spark.createDataFrame([("a",), ("b",)], "value STRING").write.text(path("in"))
    stream = read_events(spark, file_source(path("in")))
    assert stream.isStreaming and stream.columns == ["value"]
    query = stream.writeStream.format("memory").queryName("text_stream").trigger(availableNow=True).start()
    query.awaitTermination()
    assert multiset(spark.table("text_stream")) == ["Row(value='a')", "Row(value='b')"]


def test_table_scan_reads_only_asked_columns(spark, path):
    append_table(spark.range(3).selectExpr("id", "id AS other"), path("t"))
    table = read_table(spark, path("t"), columns=["id"])
    assert table.columns == ["id"]
    assert "ReadSchema: struct<id:bigint>" in table._jdf.queryExecution().executedPlan().toString()


def test_merged_schemas(spark, path):
    append_table(spark.range(3).toDF("id"), path("t"))
    append_table(spark.range(3).selectExpr("id", "'x' AS s"), path("t"))
    merged = read_table(spark, path("t"), merge_schema=True)
    assert sorted(merged.columns) == ["id", "s"]
    assert merged.count() == 6 and merged.where("s IS NULL").count() == 3


def test_csv(spark, path):
    lines = ["timestamp,x,note", "t1,1.5,a", 't2,,"b, c"', "t3,oops,", 't4,1e3,"say ""hi"" \\"']
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.text(path("csv"))
    rows = read_csv(spark, path("csv"), struct(timestamp="string", x="double", note="string"))
    assert [tuple(row) for row in rows.orderBy("timestamp").collect()] == [
        ("t1", 1.5, "a"), ("t2", None, "b, c"), ("t3", None, None), ("t4", 1000.0, 'say "hi" \\'),
    ]


def test_local_rows(spark):
    rows = local_rows(spark, [("A", 10), ("B", 20)], struct(key="string", value="long"))
    assert rows.dtypes == [("key", "string"), ("value", "bigint")]
    assert multiset(rows) == ["Row(key='A', value=10)", "Row(key='B', value=20)"]


def test_local_rows_are_broadcast_to_a_large_table(spark):
    rows = local_rows(spark, [(1, "a"), (2, None)], struct(id="long", name="string"))
    joined = spark.range(1 << 40).join(rows, "id")
    assert "BroadcastHashJoin" in plan(joined) and "BuildRight" in plan(joined)
    assert "LocalTableScan" in plan(joined)


def test_null_tests_reach_the_scan(spark, path):
    append_table(spark.range(3).selectExpr("id", "CAST(id AS DOUBLE) AS x"), path("t"))
    text = plan(drop_incomplete(read_table(spark, path("t"))))
    assert "PushedFilters: [IsNotNull(id), IsNotNull(x)]" in text


def test_csv_columns_go_by_name(spark, path):
    schema = struct(id="long", x="double", y="double")
    (spark.createDataFrame([("2.0", "1.0", "zz", "7")], "y string, x string, extra string, id string")).write.csv(path("c"), header=True)
    assert [tuple(r) for r in read_csv(spark, path("c"), schema).collect()] == [(7, 1.0, 2.0)]
    assert read_csv(spark, path("c"), schema).schema == schema
    with pytest.raises(ValueError, match="no column z"):
        read_csv(spark, path("c"), struct(id="long", z="double"))


def test_csv_files_with_headers_of_their_own(spark, path):
    base = Path(path("csv"))
    base.mkdir()
    (base / "a.csv").write_text('k,name\n1,"x, y"\n2,é\n', encoding="utf-8-sig")
    (base / "b.csv").write_text("name,extra,k\r\nz,9,3\r\n", newline="")
    (base / "c.csv.gz").write_bytes(gzip.compress(b"k,name\n4,w\n"))
    (base / "d.csv").write_text("")
    schema = struct(name="string", k="long")
    rows = read_csv_by_header(spark, str(base), schema)
    assert sorted(rows.collect()) == [("w", 4), ("x, y", 1), ("z", 3), ("é", 2)]
    (base / "e.csv").write_text("k\n5\n")
    with pytest.raises(ValueError, match="e.csv.*name"):
        read_csv_by_header(spark, str(base), schema)
    rows = read_csv_by_header(spark, str(base), schema, missing_as_null=True)
    assert (None, 5) in rows.collect() and rows.count() == 5
    (base / "empty").mkdir()
    (base / "empty" / "x.csv").write_text("")
    assert read_csv_by_header(spark, str(base / "empty"), schema).collect() == []


def test_header_lines_alone_are_read(spark, path):
    """A file whose rest is no text at all has a header."""
    base = Path(path("csv"))
    base.mkdir()
    (base / "a.csv").write_bytes(b"k,name\n" + bytes(range(128, 256)) * 100)
    assert first_lines(spark, [str(base / "a.csv")] * 3) == ["k,name"] * 3


def test_types_that_widen(spark, path):
    append_table(spark.range(3).selectExpr("id", "cast(id as int) AS x", "'a' AS p"), path("t"), partition_by=["p"])
    append_table(spark.range(3, 5).selectExpr("cast(id as int) AS id", "id / 2 AS x", "true AS new", "'b' AS p"), path("t"), partition_by=["p"])
    append_table(spark.range(5, 6).selectExpr("id", "cast(id as decimal(10,2)) AS x", "'a' AS p"), path("t"), partition_by=["p"])
    rows = read_widened(spark, path("t"))
    assert rows.schema["x"].dataType.simpleString() == "double" and rows.schema["id"].dataType.simpleString() == "bigint"
    assert sorted((r.id, r.x, r.new, r.p) for r in rows.collect()) == [(0, 0.0, None, "a"), (1, 1.0, None, "a"), (2, 2.0, None, "a"), (3, 1.5, True, "b"), (4, 2.0, True, "b"), (5, 5.0, None, "a")]
    chosen = plan(rows.where("id > 3").select("x"))
    assert chosen.count("PushedFilters: [IsNotNull(id)") >= 2 and "new" not in chosen.split("ReadSchema")[1]
    append_table(spark.range(1).selectExpr("id", "'text' AS x", "'a' AS p"), path("t"), partition_by=["p"])
    with pytest.raises(ValueError, match="x of"):
        read_widened(spark, path("t"))


def test_one_footer_a_write(spark, path):
    spark.range(0, 100, 1, 8).write.parquet(path("t"))
    files = read_table(spark, path("t")).inputFiles()
    assert len(files) == 8 and len({WRITE.search(file)[0] for file in files}) == 1
