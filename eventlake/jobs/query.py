"""Register tables and run SQL over them."""

from __future__ import annotations

import json
from argparse import ArgumentParser

from eventlake.plans import catalog
from eventlake.session import session

TYPES = {"string": str, "int": int, "float": float, "bool": lambda text: {"true": True, "false": False}[text.lower()]}


def setting(text: str) -> tuple[str, object]:
    """``NAME=VALUE``, ``NAME:TYPE=VALUE`` or ``NAME:TYPE[]=JSON-LIST`` as a name and a typed value.

    The name of a table or column is a string; the query says ``IDENTIFIER(:name)``.
    """
    name, _, value = text.partition("=")
    name, _, kind = name.partition(":")
    kind = kind or "string"
    element = kind.removesuffix("[]")
    if element not in TYPES:
        raise ValueError(f"{kind} is none of {', '.join(TYPES)}, nor a list (TYPE[]) of one")
    if element == kind:
        return name, TYPES[kind](value)
    values = json.loads(value)
    if not isinstance(values, list) or None in values:
        raise ValueError(f"{name} must be a JSON list without nulls")
    return name, [TYPES[element](str(v) if element == "bool" else v) for v in values]


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--table", action="append", default=[], metavar="SCHEMA.TABLE=PATH")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--sql", help="query; values for its :name markers come from --set")
    parser.add_argument("--set", action="append", default=[], metavar="NAME[:TYPE]=VALUE", help=", ".join(TYPES) + ", or a JSON list of them, TYPE[]")
    parser.add_argument("--output", help="directory for the whole result; without it rows are printed")
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--rows", type=int, default=20, help="rows to print; whether there are more is told")
    parser.add_argument("--count", action="store_true", help="also tell how many rows were left out")
    arguments = parser.parse_args(argv)
    spark = session("query")
    for entry in arguments.table:
        table, path = entry.split("=", 1)
        catalog.create_schema(spark, table.rpartition(".")[0] or "default")
        catalog.register(spark, table, path, arguments.format)
    if not arguments.sql:
        return
    result = catalog.query(spark, arguments.sql, **dict(map(setting, arguments.set)))
    if arguments.output:
        result.write.format(arguments.output_format).save(arguments.output)
        return
    if arguments.count:
        result = result.cache()  # one run serves both
    head = result.take(arguments.rows + 1)
    spark.createDataFrame(head[: arguments.rows], result.schema).show(arguments.rows, truncate=False)
    if len(head) > arguments.rows:
        print(f"{f'{result.count() - arguments.rows} ' if arguments.count else ''}more rows; --output writes them all")


if __name__ == "__main__":
    main()
