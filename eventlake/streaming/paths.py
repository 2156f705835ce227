"""Output and checkpoint locations that belong together."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from eventlake.sources.paths import exists, has_content


@dataclass(frozen=True)
class StreamPaths:
    """Versioned checkpoint [STR2] with the versioned outputs it accounts for.

    Starting from scratch means the next version of all of them [STR6]: nothing
    is deleted, and the old tables stay readable until their owner drops them.
    """

    base: str
    checkpoints: str
    version: int = 1

    @property
    def checkpoint(self) -> str:
        return f"{self.checkpoints.rstrip('/')}/v{self.version}"

    def output(self, table: str = "") -> str:
        return "/".join(part for part in (self.base.rstrip("/"), table, f"v{self.version}") if part)

    def reprocess(self) -> StreamPaths:
        return replace(self, version=self.version + 1)


def require_paired(spark: SparkSession, checkpoint: str, *outputs: str) -> None:
    """Refuse a checkpoint that knows nothing of outputs that already hold data.

    Batch numbers would start over: a file sink would skip new data as already
    committed, and per-batch overwrites would replace older batches.
    """
    if exists(spark, f"{checkpoint}/offsets"):
        return
    for path in outputs:
        if has_content(spark, path):
            raise ValueError(
                f"{path} was written under another checkpoint than {checkpoint}; "
                "to start from scratch, move both to their next version"
            )
