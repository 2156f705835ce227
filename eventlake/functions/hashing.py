"""Row hashes that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(columns: list[Column | str], buckets: int) -> Column:
    """Bucket 0..buckets-1 of a row, from the first 32 bits of md5 over its columns' texts, joined by hyphens.

    A null has a text of its own, so it moves no other column into its place.
    Rows whose joined texts are equal, such as a-b, c and a, b-c, share a bucket.
    """
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\0null")) for c in columns]
    digest = F.md5(F.concat_ws("-", *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
