"""Tables by name, and SQL over them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.paths import qualified

#: Property of a view that holds the directory it shows.
PATH = "eventlake.path"
#: The engine's switches for plans by statistics.
COST = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_schema(spark: SparkSession, schema: str) -> None:
    """Schema, unless it is there [CAT1]."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")


def location(spark: SparkSession, table: str) -> str:
    """Directory of a registered table."""
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect()}
    if PATH in properties:
        return properties[PATH]
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}")
    return details.where(F.col("col_name") == "Location").first().data_type


def register(spark: SparkSession, table: str, path: str, format: str = "parquet") -> None:
    """Existing directory under the name ``schema.table`` [CAT2].

    A Delta directory becomes an external table, whose log tells each query what
    is committed. A directory of files becomes a view over its path: each query
    lists it anew, so what a stream or a batch adds later is seen without
    another registration and no list of partitions is kept anywhere. Registering
    again takes up new columns; another directory under a name in use is an error.
    """
    if spark.catalog.tableExists(table) and qualified(spark, location(spark, table)) != qualified(spark, path):
        raise ValueError(f"{table} is registered at {location(spark, table)}, not {path}")
    if format == "delta":
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=path, source=format)
        spark.catalog.refreshTable(table)
        return
    target = qualified(spark, path)
    escaped = target.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(table)} TBLPROPERTIES ('{PATH}' = '{escaped}') "
        f"AS SELECT * FROM {_quoted(format)}.`{target.replace('`', '``')}`"
    )


def register_finished(spark: SparkSession, table: str, path: str, format: str = "parquet", columns: Iterable[str] | None = None) -> None:
    """A directory that nothing is added to any more, as an external table with statistics [CAT2].

    They are of the table and of ``columns``, all by default: rows, bytes,
    distinct values, nulls, least and greatest, from one scan now. The optimizer
    orders joins by them inside :func:`by_cost`. Registering again takes them
    anew; a view of that name, as :func:`register` makes for directories that
    still grow, is an error, and so is another directory.
    """
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            raise ValueError(f"{table} is a view of a directory that may grow")
        if qualified(spark, location(spark, table)) != qualified(spark, path):
            raise ValueError(f"{table} is registered at {location(spark, table)}, not {path}")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=qualified(spark, path), source=format)
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    chosen = "ALL COLUMNS" if columns is None else f"COLUMNS {', '.join(map(_quoted, columns))}"
    spark.sql(f"ANALYZE TABLE {_quoted(table)} COMPUTE STATISTICS FOR {chosen}")


@contextmanager
def by_cost(spark: SparkSession) -> Iterator[None]:
    """Queries run in the block have their joins ordered by what the tables' statistics say they cost [CAT3]."""
    before = {name: spark.conf.get(name) for name in COST}
    try:
        for name in COST:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def query(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """SQL over registered tables [CAT3, PRJ8, LIM1], values bound to ``:name`` markers [CAT4].

    A list is bound as an array (``array_contains(:names, column)``); it may be
    empty. A string stands for a table or column as ``IDENTIFIER(:name)``; it can
    name one but never add SQL.
    """
    lists = {name: F.array(*map(F.lit, value)) for name, value in parameters.items() if isinstance(value, list)}
    return spark.sql(text, args={**parameters, **lists} or None)
