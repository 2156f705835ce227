"""CSV files to messages."""

from __future__ import annotations

from argparse import ArgumentParser

from eventlake.schemas import EVENT
from eventlake.session import session
from eventlake.sinks.publish import publish, to_messages
from eventlake.sources.tables import read_csv


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True)
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--messages", help="directory for text messages, instead of a topic")
    parser.add_argument("--missing-as-null", action="store_true", help="publish missing values as null, not NaN")
    parser.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE", help="such as kafka.acks=all")
    arguments = parser.parse_args(argv)
    options = dict(option.split("=", 1) for option in arguments.sink_option)
    spark = session("publish")
    messages = to_messages(read_csv(spark, arguments.csv, EVENT), missing_as_nan=not arguments.missing_as_null)
    if arguments.messages:
        publish(messages, "text", arguments.messages, **options)
    else:
        servers = {"kafka.bootstrap.servers": arguments.servers, "topic": arguments.topic}
        publish(messages, "kafka", **{**servers, **options})


if __name__ == "__main__":
    main()
