"""Directory tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.operators.physical import rebalanced
from eventlake.sources.paths import children, create_once, exists, read_text, remove, rename

BATCH_ID = "batch_id"
#: File formats that keep their columns' names and types, so that a batch reads back as it was written.
TYPED = ("parquet", "orc", "avro")
#: Directory, below a table, of batches that are being put together.
COMPACTING = "_compacting"
#: The same of batches that are being replaced.
REPLACING = "_replacing"


def append_table(
    rows: DataFrame,
    path: str,
    format: str = "parquet",
    merge_schema: bool = False,
    partition_by: Iterable[str] = (),
    rebalance: bool = False,
) -> None:
    """Rows appended to a table, with new columns where ``merge_schema`` allows them [SNK2]. Batch only.

    With ``rebalance`` the engine sizes the files [PHY1], for one shuffle of the rows.

    A plain file table takes any columns; there the option belongs to the reader.
    A directory that a stream writes is refused: readers go by the stream's own
    list of files, so rows added beside it would never be seen. Append to a
    second table instead.
    """
    if format != "delta" and exists(rows.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"a stream writes {path}; rows appended there would not be seen, use a second table")
    partition_by = list(partition_by)
    if rebalance:
        rows = rebalanced(rows, partition_by)
    writer = rows.write.format(format).mode("append").partitionBy(*partition_by)
    if merge_schema:
        writer = writer.option("mergeSchema", True)
    writer.save(path)


def require_typed(format: str) -> None:
    """Refuse a format whose files do not keep names and types."""
    if format != "delta" and format not in TYPED:
        raise ValueError(f"batches need a format that stores its schema ({', '.join(TYPED)} or delta), not {format}")


def write_batch(rows: DataFrame, path: str, batch_id: int, format: str = "parquet", app_id: str | None = None) -> None:
    """One micro-batch, so that a retried batch replaces itself [STR3].

    With Delta the table's transaction log skips a batch that ``app_id`` has
    already committed, and ``batch_id`` is a plain column. Elsewhere the batch
    has a directory of its own, which a retry overwrites; a batch that
    :func:`compact` has put together with others is not written again.
    """
    require_typed(format)
    if format == "delta":
        (
            rows.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
            .write.format(format)
            .mode("append")
            .options(mergeSchema=True, txnAppId=app_id, txnVersion=batch_id)
            .save(path)
        )
    elif batch_id > compacted_to(rows.sparkSession, path):
        rows.write.format(format).mode("overwrite").save(f"{path}/{BATCH_ID}={batch_id}")


def read_batch(
    spark: SparkSession, path: str, batch_id: int, format: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Committed rows of one micro-batch, listing no other batch's files; ``schema`` is what was written."""
    if format == "delta":
        table = spark.read.format(format).load(path)
        return table.where(F.col(BATCH_ID) == batch_id).drop(BATCH_ID)
    reader = spark.read.format(format)
    return (reader if schema is None else reader.schema(schema)).load(f"{path}/{BATCH_ID}={batch_id}")


def _batches(spark: SparkSession, path: str) -> list[int]:
    start = f"{BATCH_ID}="
    return sorted(int(name[len(start) :]) for name in children(spark, path) if name.startswith(start))


def compacted_to(spark: SparkSession, path: str) -> int:
    """The last batch that a compaction has taken up; -1 without one."""
    done = [int(name.partition("=")[2]) for name in children(spark, f"{path}/{COMPACTING}") if name.startswith("upto=")]
    return max(done, default=-1)


def compact(spark: SparkSession, path: str, format: str = "parquet", keep: int = 10, partitions: int | None = None) -> int:
    """All batches but the last ``keep`` (one at least) put into one directory, that of the newest of them; returns how many there were.

    For file tables written batch by batch; a Delta table has its own OPTIMIZE.
    Rows keep their columns except that ``batch_id`` becomes that of the
    directory. The stream must be stopped: between the removal of the old
    directories and the move of the new one, readers miss those rows. The new
    directory is complete before anything is removed, and a compaction that was
    cut short is finished by the next one. Later retries of a batch that is in
    it write nothing, so rows neither double nor disappear.
    """
    require_typed(format)
    if keep < 1:
        raise ValueError("the last batch may be tried again by its stream and must keep a directory of its own: keep >= 1")
    work = f"{path}/{COMPACTING}"
    for name in children(spark, work):
        if name.startswith("ready="):
            _swap(spark, path, int(name.partition("=")[2]))
    old = _batches(spark, path)
    old = old[: max(0, len(old) - keep)]
    if len(old) < 2:
        return 0
    last = old[-1]
    rows = spark.read.format(format).option("mergeSchema", True).option("basePath", path)
    rows = rows.load([f"{path}/{BATCH_ID}={batch}" for batch in old]).drop(BATCH_ID)
    if partitions is not None:
        rows = rows.coalesce(partitions)
    remove(spark, f"{work}/new={last}")
    rows.write.format(format).save(f"{work}/new={last}")
    rename(spark, f"{work}/new={last}", f"{work}/ready={last}")
    _swap(spark, path, last)
    return len(old)


def _swap(spark: SparkSession, path: str, last: int) -> None:
    """The complete new directory in place of the old ones up to ``last``; may be repeated at any point."""
    work = f"{path}/{COMPACTING}"
    spark.range(0).write.mode("overwrite").parquet(f"{work}/upto={last}")
    for batch in _batches(spark, path):
        if batch <= last:
            remove(spark, f"{path}/{BATCH_ID}={batch}")
    rename(spark, f"{work}/ready={last}", f"{path}/{BATCH_ID}={last}")


def replace_batches(rows: DataFrame, path: str, batches: Iterable[int], format: str = "parquet") -> None:
    """Rows in place of those of some batches, as the newest of them [STR6].

    For tables written batch by batch, while their stream is stopped. The new
    directory is complete before anything is removed; until it is moved, readers
    miss those rows. One that was cut short is finished by the next call. What
    :func:`compact` has put together can only be replaced together.
    """
    require_typed(format)
    spark, ids = rows.sparkSession, sorted(set(batches))
    last = ids[-1]
    if format == "delta":
        chosen = f"{BATCH_ID} IN ({', '.join(map(str, ids))})"
        new = rows.withColumn(BATCH_ID, F.lit(last).cast("bigint")).write.format(format)
        new.mode("overwrite").option("replaceWhere", chosen).save(path)
        return
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} has no batches of its own; take its next version to start from scratch")
    work = f"{path}/{REPLACING}"
    for name in children(spark, work):
        if name.startswith("ready="):
            _put(spark, path, int(name.partition("=")[2]))
    folded = compacted_to(spark, path)
    if ids[0] <= folded and not set(range(folded + 1)) <= set(ids):
        raise ValueError(f"batches 0 to {folded} were put together and can only be replaced together")
    remove(spark, f"{work}/new={last}")
    remove(spark, f"{work}/ids={last}")
    rows.write.format(format).save(f"{work}/new={last}")
    create_once(spark, f"{work}/ids={last}", ",".join(map(str, ids)))
    rename(spark, f"{work}/new={last}", f"{work}/ready={last}")
    _put(spark, path, last)


def _put(spark: SparkSession, path: str, last: int) -> None:
    """The complete new directory in place of the batches on its list; may be repeated at any point."""
    work = f"{path}/{REPLACING}"
    for batch in read_text(spark, f"{work}/ids={last}").split(","):
        remove(spark, f"{path}/{BATCH_ID}={batch}")
    rename(spark, f"{work}/ready={last}", f"{path}/{BATCH_ID}={last}")
    remove(spark, f"{work}/ids={last}")
