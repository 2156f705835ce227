"""Layout hints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows in ``partitions`` partitions [PHY1]. Batch only.

    Worth its shuffle where a table has fewer file splits than the cluster has
    cores; the caller knows both.
    """
    return rows.repartition(partitions)


#: Rows of one task, where work is dealt out by their number.
TASK_ROWS = 250_000


def tasks_of(rows: DataFrame, rows_per_task: int = TASK_ROWS) -> int:
    """How many tasks the number of rows asks for; of a plain file table, counted from its footers. Batch only."""
    return max(1, -(-rows.count() // rows_per_task))


def spread_by_rows(rows: DataFrame, rows_per_task: int = TASK_ROWS) -> DataFrame:
    """Rows in partitions of at most about ``rows_per_task``, those of one task as they are [PHY1]. Batch only.

    How many tasks scan a file goes by its row groups and by the executors that
    are there when it is planned; what a task holds of these rows does not.
    """
    tasks = tasks_of(rows, rows_per_task)
    return rows if tasks == 1 else spread(rows, max(tasks, rows.sparkSession.sparkContext.defaultParallelism))


def rebalanced(rows: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Rows in partitions of the size that the engine advises, for a write [PHY1]. Batch only.

    Adaptive execution merges small partitions and splits large ones
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a table gets few
    files of a good size whatever the number of tasks. ``by``, the columns a
    table is partitioned by, brings the rows of a directory together; a value
    that holds much of the table is split over several tasks and files.
    """
    return rows.hint("rebalance", *by)


@contextmanager
def held(rows: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Rows cached for the block and released after it [PHY2]; blocks spill instead of being lost. Batch only."""
    cached = rows.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
