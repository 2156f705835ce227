"""Batch tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.sources.paths import first_lines


#: What the files of one write share in their names.
WRITE = re.compile(r"(?<=part-\d{5}-)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    columns: Iterable[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Directory table scan [SRC5]; ``merge_schema`` shows the columns of all its files [SNK2]."""
    reader = spark.read.format(format)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    table = reader.load(path)
    return table if columns is None else table.select(*columns)


def read_widened(spark: SparkSession, path: str, format: str = "parquet", threads: int = 16) -> DataFrame:
    """A file table whose columns changed their types between appends, or came and went [SNK2, SRC5].

    Files are grouped by their own schema, each group is read by it, so filters
    and column choices still reach its scan, and the groups are put together by
    name: a column has the type that all of its types widen to (whole numbers to
    larger ones, to decimals or to doubles, dates to timestamps, by the engine's
    rules), and is null where a group lacks it. Text and anything else have no
    common type; that is an error that names the column. One footer is read for
    each write of the table, as one write gives all its files one schema.
    """
    base = {} if "*" in path else {"basePath": path}  # keeps partition columns
    writes: dict[str, list[str]] = {}
    for file in spark.read.format(format).load(path).inputFiles():
        named = WRITE.search(file)
        writes.setdefault(named[0] if named else file, []).append(file)
    reader = spark.read.format(format).options(**base)
    with ThreadPool(threads) as pool:
        schemas = pool.map(lambda files: reader.load(files[0]).schema, writes.values())
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for schema, files in zip(schemas, writes.values(), strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].extend(files)
    kinds: dict[str, set[bool]] = {}
    for schema, _ in groups.values():
        for field in schema.fields:
            kinds.setdefault(field.name, set()).add(isinstance(field.dataType, StringType))
    mixed = [name for name, kind in kinds.items() if len(kind) > 1]
    if mixed:
        raise ValueError(f"{', '.join(mixed)} of {path}: text in some files and another type in others")
    parts = [spark.read.format(format).options(**base).schema(schema).load(files) for schema, files in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, **options) -> DataFrame:
    """CSV files with a header row and a stated schema, columns matched by name, so no inference pass [SRC6].

    Only the header line is read ahead. Columns that ``schema`` does not name are
    left out, their order is of no matter, and a missing one is an error. All
    files have the first one's header; one with another is an error when read
    (:func:`read_csv_by_header` reads such directories). A
    quote inside quotes is doubled. Files are split between tasks, so a line
    break inside quotes needs ``multiLine=True``, which reads each file whole.
    """
    settings = {"header": True, "escape": '"', **options}
    header = spark.read.options(**settings, inferSchema=False).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    there = StructType([schema[name] if name in schema.names else StructField(name, StringType()) for name in header])
    return spark.read.options(**settings, enforceSchema=False).schema(there).csv(path).select(*schema.names)


def read_csv_by_header(spark: SparkSession, path: str, schema: StructType, missing_as_null: bool = False, **options) -> DataFrame:
    """As :func:`read_csv`, of files whose headers differ in order or columns [SRC6].

    Files are grouped by their own first line, each group is read by it, and the
    groups are put together by name. Only first lines are read ahead, on the
    driver, one small request a file. With ``missing_as_null`` a column that a
    group lacks is null there; otherwise it is an error that names one of its
    files. Empty files have no rows.
    """
    files = spark.read.text(path).inputFiles()
    groups: dict[str, list[str]] = {}
    for file, line in zip(files, first_lines(spark, files), strict=True):
        if line.strip():
            groups.setdefault(line.rstrip("\r"), []).append(file)
    if not groups:
        return spark.createDataFrame([], schema)
    parts = []
    for own in groups.values():
        wanted = schema
        if missing_as_null:
            header = spark.read.options(**{"header": True, "escape": '"', **options}).csv(own[0]).columns
            wanted = StructType([field for field in schema.fields if field.name in header])
        rows = read_csv(spark, own, wanted, **options)
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in wanted.names]
        parts.append(rows.select("*", *lacking).select(*schema.names))
    return reduce(DataFrame.unionAll, parts)


def local_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A handful of driver rows as a DataFrame, with a stated schema [SRC7].

    They travel inside the plan, as an Arrow table, so the optimizer knows their
    size: a join broadcasts them. Rows of a plain Python list have no known
    size, and a join with them would shuffle the other side.
    """
    values = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(values, to_arrow_schema(schema)), schema)
