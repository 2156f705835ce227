import math

from conftest import multiset

from eventlake.operators.clean import drop_incomplete, to_double

ROWS = [
    (1, 1.0, "a"),
    (2, None, "a"),
    (3, math.nan, "a"),
    (4, math.inf, "a"),
    (5, 1.0, None),
    (6, -math.inf, "NaN"),
]


def ids(frame):
    return sorted(row.id for row in frame.collect())


def test_null_and_nan_are_incomplete_infinity_is_not(spark):
    rows = spark.createDataFrame(ROWS, "id INT, x DOUBLE, s STRING")
    assert ids(drop_incomplete(rows)) == [1, 4, 6]
    assert ids(drop_incomplete(rows, ["x"])) == [1, 4, 5, 6]
    assert ids(drop_incomplete(rows, ["s"])) == [1, 2, 3, 4, 6]


def test_casts_give_null_for_text_that_is_no_number(spark):
    rows = spark.createDataFrame([("1.5", 2), ("abc", 3), (None, None), ("NaN", 4)], "x STRING, y INT")
    cast = to_double(rows, ["x", "y"])
    assert cast.dtypes == [("x", "double"), ("y", "double")]
    assert multiset(cast) == multiset(
        spark.createDataFrame([(1.5, 2.0), (None, 3.0), (None, None), (math.nan, 4.0)], "x DOUBLE, y DOUBLE")
    )


def test_cast_keeps_asked_columns_only(spark):
    rows = spark.createDataFrame([("k", "1", "z")], "k STRING, x STRING, z STRING")
    assert to_double(rows, ["x"], keep=["k"]).first() == ("k", 1.0)
