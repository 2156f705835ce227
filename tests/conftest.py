import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from eventlake.functions.hashing import hash_bucket  # noqa: E402
from eventlake.schemas import EVENT, FEATURES, LABEL  # noqa: E402
from eventlake.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def path(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture(scope="session")
def events(spark, tmp_path_factory):
    """2,000 complete events whose label is 0.1 to 1.0 times the features plus noise in [0, 1), less 20."""
    rows = spark.range(2000).select(
        "id", *[(hash_bucket(["id", F.lit(name)], 1000) / 100.0).alias(name) for name in FEATURES]
    )
    label = sum((F.col(name) * (0.1 * (i + 1)) for i, name in enumerate(FEATURES)), F.lit(-20.0))
    table = str(tmp_path_factory.mktemp("events") / "table")
    rows.select(
        *[
            {
                "timestamp": F.concat(F.lit("t"), F.col("id").cast("string")),
                "cargo_condition_status": F.lit("ok"),
                LABEL: label + hash_bucket(["id", F.lit("noise")], 100) / 100.0,
                "delay_probability": F.lit(0.5),
                "risk_classification": F.lit("unknown"),
            }
            .get(name, F.col(name))
            .alias(name)
            for name in EVENT.names
        ]
    ).write.parquet(table)
    return spark.read.parquet(table)


def multiset(frame):
    """Rows of a frame, order aside, NaN equal to itself."""
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
