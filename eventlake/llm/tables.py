"""Reading the text tables, cutting lineage through the shared folder, and Arrow columns as NumPy buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.session import work_path
from eventlake.sources.paths import remove

#: Bytes of text that NumPy code works on at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
BYTES_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS rows and about BATCH_BYTES between Spark and Python, unless the session has numbers of its own.

    Spark's defaults, 10,000 rows and 64 MB, are held on both sides by every task.
    """
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    if spark.conf.get(BYTES_CONF) in ("67108864b", "64MB"):
        spark.conf.set(BYTES_CONF, f"{BATCH_BYTES}b")


_made: list[str] | None = None


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths of all tables that :func:`written` makes in the block, for whoever knows when they are done with."""
    global _made
    before, _made = _made, []
    try:
        yield _made
    finally:
        _made = before


def drop_unused(docs: DataFrame, paths: list[str]) -> list[str]:
    """Removes the tables at `paths`, but for those that `docs` still reads; these are returned."""
    files = docs.inputFiles()
    kept = [path for path in paths if any(path.rsplit("/", 1)[1] in file for file in files)]
    for path in paths:
        if path not in kept:
            remove(docs.sparkSession, path)
    return kept


def alone(make: Callable[[], DataFrame]) -> DataFrame:
    """The written table that `make` returns; the working tables it was made from are removed."""
    with scratch() as made:
        result = make()
    kept = drop_unused(result, made)
    if _made is not None:
        _made.extend(kept)
    return result


def written(df: DataFrame, name: str, rows: int | None = None, rows_per_task: int = 200_000) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the reading of a file, not the work
    that made it. The files lie under the session's checkpoint folder. `rows`, an
    upper bound where one is known, keeps small tables from becoming many files:
    a task for each `rows_per_task` rows, and never more than there were.
    """
    small_batches(df.sparkSession)
    path = work_path(df.sparkSession, name)
    if _made is not None:
        _made.append(path)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_per_task)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or data.size == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Gives back what Arrow keeps for later; called where a task's Python function ends, as its process serves the tasks that follow."""
    pa.default_memory_pool().release_unused()


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, min(end, rows)
        row = end


def with_fields(rows: DataFrame, carried: list[str], made: str) -> StructType:
    """Schema of the carried columns of `rows`, whatever their names and types, and the fields that DDL `made` tells."""
    return StructType([*[rows.schema[c] for c in carried], *StructType.fromDDL(made).fields])


def text_key(column: str = "text"):
    """128-bit key of a text, equal for equal texts; null for null."""
    return F.unhex(F.md5(F.col(column).cast("binary")))


def in_fold(column: str, folds: int, held: int):
    """Whether crc32 of the id as text, modulo `folds`, is `held`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == held


def bit_filter(values: DataFrame, least_bits: int = 20, most_bits: int = 27) -> np.ndarray:
    """Bits at hashes of the values of a one-column frame of longs, as rows of bytes: a filter without false negatives.

    Every value has a bit in each row. The filter has 16 bits a value or more,
    but never more than 2**most_bits (16 MB), so what goes to the driver and to
    the tasks is bounded. Until then about one other value in 400 is let
    through at most, so what passes by chance grows with the values asked for
    alone. Beyond that more are, and the join behind it sorts them out.
    """
    value = values.columns[0]
    count = values.count()
    bits = min(most_bits, max(least_bits, (16 * count).bit_length()))
    # a full filter lets fewer through with fewer rows: 0.7 times the bits a value has is best
    rows = 4 if 1 << bits > 4 * count else 2 if 1 << bits > 2 * count else 1
    width = bits + 1 - rows.bit_length()
    hashes = values.select(F.xxhash64(value).alias("hash"))
    first = F.shiftrightunsigned("hash", 64 - width)
    step = F.col("hash").bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(1))
    # positions from 1, row after row; maps of 32,768 bits are put together on the executors
    places = F.array(*[(first + row * step).bitwiseAND(F.lit((1 << width) - 1)) + 1 + (row << width) for row in range(rows)])
    placed = hashes.select(F.explode(places).alias("place"))
    maps = placed.groupBy(F.bitmap_bucket_number("place").alias("map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    found = maps.toArrow()
    seen = np.zeros(1 << (bits - 3), np.uint8)
    for number, own in zip(found.column("map").to_pylist(), found.column("bits").to_pylist(), strict=True):
        seen[(number - 1) * MAP_BYTES : number * MAP_BYTES] = np.frombuffer(own, np.uint8)
    return seen.reshape(rows, -1)


#: Bytes of one of Spark's bitmaps.
MAP_BYTES = 4096

_P1, _P2, _P3, _P4, _P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64_of_longs(values: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each 64-bit value, as Spark's xxhash64 of a long. The constants are the hash's own, fixed values."""
    h = np.full(len(values), (seed + _P5 + 8) % (1 << 64), np.uint64)
    h ^= _turned(values.view(np.uint64) * np.uint64(_P2), 31) * np.uint64(_P1)
    h = _turned(h, 27) * np.uint64(_P1) + np.uint64(_P4)
    h ^= h >> np.uint64(33)
    h *= np.uint64(_P2)
    h ^= h >> np.uint64(29)
    h *= np.uint64(_P3)
    return h ^ (h >> np.uint64(32))


def in_filter(seen: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit values may be in a `bit_filter`; one of a single row may come as plain bytes."""
    seen = np.atleast_2d(seen)
    width = seen.shape[1].bit_length() + 2
    hashes = xxhash64_of_longs(values)
    left = np.arange(len(values))
    for row, bits in enumerate(seen):
        own = hashes[left]
        place = ((own >> np.uint64(64 - width)) + np.uint64(row) * (own | np.uint64(1))) & np.uint64((1 << width) - 1)
        place = place.astype(np.int64)
        left = left[(bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
    found = np.zeros(len(values), bool)
    found[left] = True
    return found
