"""Train and test parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.hashing import hash_bucket

PART = "part"
TRAIN, TEST = "train", "test"

# Share of training rows and seed.
TRAIN_SHARE = 0.8
SEED = 42


def random_split(
    rows: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; sorts every partition to repeat itself [ML2]. Batch only."""
    train, test = rows.randomSplit([share, 1.0 - share], seed=seed)
    return train, test


def random_part(share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    """Part of a row by lot, for rows that are written down once [ML2]."""
    return F.when(F.rand(seed) < share, F.lit(TRAIN)).otherwise(F.lit(TEST))


def hash_part(keys: list[str], share: float = TRAIN_SHARE) -> Column:
    """Part of a row by its key: equal in every run, engine and layout [ML2].

    Rows with equal keys stay together, so a key that holds much of the table
    moves the share; use :func:`random_part` there.
    """
    bucket = hash_bucket(keys, 10_000)
    return F.when(bucket < round(share * 10_000), F.lit(TRAIN)).otherwise(F.lit(TEST))
