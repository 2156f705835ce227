"""Message stream to table."""

from __future__ import annotations

from argparse import ArgumentParser

from eventlake.jobs.arguments import add_source, add_stream, read_source, trigger
from eventlake.session import session
from eventlake.streaming.ingest import ingest, ingest_or_reject
from eventlake.streaming.run import run_all


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    add_source(parser, starting_offsets="latest")
    add_stream(parser)
    parser.add_argument("--output", required=True)
    parser.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE", help="such as retention=30d")
    parser.add_argument("--allow-existing", action="store_true", help="let a new checkpoint add to a Delta table that holds data")
    parser.add_argument("--rejects", help="table for the text of what is no message; both tables then have a batch_id")
    arguments = parser.parse_args(argv)
    if arguments.rejects and (arguments.sink_option or arguments.allow_existing):
        parser.error("--rejects writes batch by batch and takes neither --sink-option nor --allow-existing")
    spark = session("ingest")
    messages = read_source(spark, arguments)
    if arguments.rejects:
        both = (arguments.output, arguments.rejects, arguments.checkpoint)
        run_all([ingest_or_reject(messages, *both, format=arguments.format, trigger=trigger(arguments))])
        return
    run_all(
        [
            ingest(
                messages,
                arguments.output,
                arguments.checkpoint,
                format=arguments.format,
                trigger=trigger(arguments),
                options=dict(option.split("=", 1) for option in arguments.sink_option),
                allow_existing=arguments.allow_existing,
            )
        ]
    )


if __name__ == "__main__":
    main()
