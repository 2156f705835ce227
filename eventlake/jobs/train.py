"""Event table to the latest model."""

from __future__ import annotations

from argparse import ArgumentParser

from eventlake.operators.split import hash_part
from eventlake.plans.registry import ModelRegistry
from eventlake.plans.training import train
from eventlake.session import session
from eventlake.sources.tables import read_table


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--events", required=True, help="event table")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--models", required=True, help="directory of the model registry")
    parser.add_argument("--required", nargs="+", help="columns a row must have; all by default")
    parser.add_argument("--split-by", nargs="+", help="key columns of a repeatable split; by lot otherwise")
    parser.add_argument("--cache", action="store_true", help="hold the training part over the fits")
    parser.add_argument("--partitions", type=int, help="deal the training rows out over so many partitions")
    parser.add_argument("--rebalance", action="store_true", help="let the engine size the training table's files")
    arguments = parser.parse_args(argv)
    spark = session("train")
    result = train(
        read_table(spark, arguments.events, arguments.format),
        required=arguments.required,
        part=hash_part(arguments.split_by) if arguments.split_by else None,
        cache=arguments.cache,
        partitions=arguments.partitions,
        rebalance=arguments.rebalance,
    )
    print(f"rows: {result.table.count()} at {result.table.path}")
    result.leaderboard.show(truncate=False)
    path = ModelRegistry(spark, arguments.models).publish(result.best_model, result.best_name, result.best_rmse)
    print(f"latest model: {path}")


if __name__ == "__main__":
    main()
