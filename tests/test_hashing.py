from eventlake.functions.hashing import hash_bucket


def test_nulls_keep_their_place(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("a", "b")], "x string, y string")
    assert len({r[0] for r in rows.select(hash_bucket(["x", "y"], 1 << 30)).collect()}) == 4
