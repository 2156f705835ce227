"""Message stream to predictions and alerts, by the latest model."""

from __future__ import annotations

import json
from argparse import ArgumentParser

from eventlake.jobs.arguments import add_source, add_stream, read_source, trigger
from eventlake.plans.registry import ModelRegistry
from eventlake.session import session
from eventlake.streaming.progress import BatchCounts
from eventlake.streaming.run import run_all
from eventlake.streaming.scoring import start_scoring

#: Pause between batches unless --every or --once is given: file tables gain a directory a batch.
EVERY = "1 minute"


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    add_source(parser, starting_offsets="earliest")
    add_stream(parser)
    parser.add_argument("--models", required=True, help="directory of the model registry")
    parser.add_argument("--model", help="one model's path, instead of the latest")
    parser.add_argument("--predictions", required=True)
    parser.add_argument("--alerts", required=True)
    parser.add_argument("--debug", action="store_true", help="print the decoded events")
    parser.add_argument("--follow", action="store_true", help="take the latest model anew for each batch")
    parser.add_argument("--counts", action="store_true", help="print the counts of each batch")
    arguments = parser.parse_args(argv)
    if arguments.follow and arguments.model:
        parser.error("--follow takes the latest model, --model a stated one")
    spark = session("score")
    registry = ModelRegistry(spark, arguments.models)
    run_all(
        start_scoring(
            read_source(spark, arguments),
            registry if arguments.follow else registry.load(arguments.model),
            arguments.predictions,
            arguments.alerts,
            arguments.checkpoint,
            debug=arguments.debug,
            counts=BatchCounts(lambda counts: print(json.dumps(counts), flush=True)) if arguments.counts else None,
            format=arguments.format,
            trigger=trigger(arguments, every=EVERY),
        )
    )


if __name__ == "__main__":
    main()
