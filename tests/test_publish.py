import json
import math

from conftest import multiset

from eventlake.operators.decode import decode_json
from eventlake.schemas import struct
from eventlake.sinks.publish import publish, to_messages
from eventlake.sources.tables import read_table

SCHEMA = struct(id="long", x="double", s="string")
ROWS = [(1, 1.5, "a"), (2, None, 'quote " and\nline'), (3, math.nan, None), (4, math.inf, "é")]


def test_round_trip_through_files(spark, path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    publish(to_messages(rows), "text", path("out"))
    assert multiset(decode_json(read_table(spark, path("out"), "text"), SCHEMA)) == multiset(rows)


def test_nulls_are_spelled_out(spark):
    messages = to_messages(spark.createDataFrame([(2, None, None)], SCHEMA))
    assert json.loads(messages.first().value) == {"id": 2, "x": None, "s": None}


def test_missing_values_as_nan(spark):
    rows = spark.createDataFrame([(2, None, None), (3, 1.0, "b")], SCHEMA)
    decoded = decode_json(to_messages(rows, missing_as_nan=True), SCHEMA)
    assert multiset(decoded) == multiset(spark.createDataFrame([(2, math.nan, '"NaN"'), (3, 1.0, "b")], SCHEMA))


def test_publishing_appends(spark, path):
    rows = to_messages(spark.createDataFrame(ROWS, SCHEMA))
    publish(rows, "text", path("out"))
    publish(rows, "text", path("out"))
    assert read_table(spark, path("out"), "text").count() == 8
