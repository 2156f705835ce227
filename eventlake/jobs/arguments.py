"""Arguments that several programs share."""

from __future__ import annotations

from argparse import ArgumentParser, Namespace

from pyspark.sql import DataFrame, SparkSession

from eventlake.sources.events import file_source, kafka_source, read_events


def add_source(parser: ArgumentParser, starting_offsets: str) -> None:
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--starting-offsets", default=starting_offsets)
    parser.add_argument("--tolerate-data-loss", action="store_true")
    parser.add_argument("--security-protocol", help="such as PLAINTEXT or SASL_SSL")
    parser.add_argument("--messages", help="directory of text messages, instead of a topic")
    parser.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")


def read_source(spark: SparkSession, arguments: Namespace) -> DataFrame:
    options = dict(option.split("=", 1) for option in arguments.source_option)
    keep_all = not arguments.tolerate_data_loss
    if arguments.messages:
        # Kafka's start policy does not apply: a directory is always read from its first file.
        source = file_source(arguments.messages, fail_on_data_loss=keep_all, **options)
    else:
        source = kafka_source(
            arguments.servers,
            arguments.topic,
            arguments.starting_offsets,
            keep_all,
            arguments.security_protocol,
            **options,
        )
    return read_events(spark, source)


def add_stream(parser: ArgumentParser) -> None:
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    parser.add_argument("--every", help="pause between batches, such as '1 minute'")
    parser.add_argument("--once", action="store_true", help="stop when all present messages are processed")


def trigger(arguments: Namespace, every: str | None = None) -> dict | None:
    """What the arguments say, or batches ``every`` so often; without either they follow each other at once."""
    if arguments.once:
        return {"availableNow": True}
    every = arguments.every or every
    return {"processingTime": every} if every else None
