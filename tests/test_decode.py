"""What becomes of a payload, and at which cost."""

import json

import pytest
from conftest import multiset, plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.operators.clean import drop_incomplete
from eventlake.operators.decode import decode_json
from eventlake.schemas import EVENT, FEATURES, SCORE_EVENT, struct

SCHEMA = struct(timestamp="string", x="double", y="double")
INF = float("inf")
NAN = float("nan")

# payload, expected (timestamp, x, y), kept when x and y are required
EDGES = [
    ('{"timestamp":"t1","x":1,"y":2.5}', ("t1", 1.0, 2.5), True),
    ('{"timestamp":"t2","x":NaN,"y":1}', ("t2", NAN, 1.0), False),
    ('{"timestamp":"t3","x":"NaN","y":1}', ("t3", NAN, 1.0), False),
    ('{"timestamp":"t4","x":"1.5","y":1}', ("t4", None, 1.0), False),
    ('{"timestamp":"t5","x":null,"y":1,"extra":9}', ("t5", None, 1.0), False),
    ("not json", (None, None, None), False),
    ("", (None, None, None), False),
    (None, (None, None, None), False),
    ('[{"timestamp":"a1","x":1,"y":2},{"timestamp":"a2","x":1,"y":2}]', (None, None, None), False),
    ('{"timestamp":123,"x":true,"y":1}', ("123", None, 1.0), False),
    ('{"TIMESTAMP":"ci","x":1,"y":1}', (None, 1.0, 1.0), True),
    ('{"timestamp":"t6","x":1,"x":2,"y":1}', ("t6", 2.0, 1.0), True),
    ('{"timestamp":"trunc","x":1', (None, None, None), False),
    ('{"timestamp":"o","x":{"a":1},"y":1}', ("o", None, 1.0), False),
    ('{"timestamp":"inf","x":Infinity,"y":1e400}', ("inf", INF, INF), True),
    ('{"timestamp":NaN,"x":1.0,"y":1}', ('"NaN"', 1.0, 1.0), True),
]


@pytest.mark.parametrize("optimize", ["true", "false"])
def test_edge_payloads(spark, optimize):
    flag = "spark.sql.optimizer.enableJsonExpressionOptimization"
    spark.conf.set(flag, optimize)
    try:
        messages = spark.createDataFrame([(i, edge[0]) for i, edge in enumerate(EDGES)], "id INT, value STRING")
        decoded = decode_json(messages, SCHEMA, keep=["id"])
        rows = {row.id: (row.timestamp, row.x, row.y) for row in decoded.collect()}
        kept = {row.id for row in drop_incomplete(decoded, ["x", "y"]).collect()}
    finally:
        spark.conf.unset(flag)
    for i, (payload, expected, keep) in enumerate(EDGES):
        assert repr(rows[i]) == repr(expected), payload
        assert (i in kept) == keep, payload


NUMBERS = st.none() | st.integers(-(2**60), 2**60) | st.floats() | st.booleans() | st.sampled_from(["NaN", "1", ""])
OBJECTS = st.fixed_dictionaries({}, optional={"timestamp": st.text(max_size=5), "x": NUMBERS, "y": NUMBERS})


def as_double(value):
    """What a double field holds of a JSON value."""
    if value == "NaN":
        return NAN
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(OBJECTS, min_size=20, max_size=60))
def test_random_objects_by_brute_force(spark, objects):
    messages = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objects)], "id INT, value STRING")
    rows = decode_json(messages, SCHEMA, keep=["id"]).orderBy("id").collect()
    for row, o in zip(rows, objects, strict=True):
        assert row.timestamp == o.get("timestamp")
        assert repr((row.x, row.y)) == repr((as_double(o.get("x")), as_double(o.get("y"))))


def test_binary_and_text_payloads_agree(spark):
    messages = spark.createDataFrame([('{"timestamp":"é","x":1,"y":2}',)], "value STRING")
    binary = messages.select(F.col("value").cast("binary").alias("value"))
    assert multiset(decode_json(messages, SCHEMA)) == multiset(decode_json(binary, SCHEMA))


def test_full_event_parses_under_the_scoring_schema(spark, events):
    messages = events.limit(5).select(F.to_json(F.struct("*")).alias("value"))
    assert decode_json(messages, EVENT).columns == EVENT.names
    scored = decode_json(messages, SCORE_EVENT)
    assert scored.columns == ["timestamp", *FEATURES]
    assert drop_incomplete(scored).count() == 5


def test_one_parse_however_many_columns_are_tested(spark):
    messages = spark.range(10).select(F.lit("{}").alias("c"), F.col("id").cast("string").alias("value"))
    tested = drop_incomplete(decode_json(messages, SCORE_EVENT), FEATURES).where("lead_time_days > 1")
    assert plan(tested).count("from_json(") == 1
    assert "Exchange" not in plan(tested)
