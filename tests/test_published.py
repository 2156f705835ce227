"""Messages as files: few are dealt out, many are written in the parts they come in."""

import pytest
from pyspark.sql import functions as F

from acceptance import tables


@pytest.mark.parametrize("rows,files", [(400, tables.MESSAGE_FILES), (900, 3)])
def test_only_few_messages_are_dealt_out(spark, path, monkeypatch, rows, files):
    monkeypatch.setattr(tables, "tasks_of", lambda messages: -(-messages.count() // 100), raising=False)
    messages = spark.range(0, rows, 1, 3).select(F.col("id").cast("string").alias("value"))
    read = spark.read.text(tables.published(spark, messages, path("messages")))
    assert len(read.inputFiles()) == files and {int(r.value) for r in read.collect()} == set(range(rows))
