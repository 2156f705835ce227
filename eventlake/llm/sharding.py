"""Rendezvous hashing of stable keys over weighted shards, and gapless places inside each shard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import written

#: Rows of one piece of a shard, on average, while places are given.
PIECE_ROWS = 50_000
#: Digits of the hash that make a number: 52 bits, exact in a double.
_DIGITS, _SPAN = 13, float(1 << 52)


def _unit(*parts: Column) -> Column:
    """A number above 0 and below 1, decided by the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / _SPAN


def rendezvous_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard with the highest score -weight / ln(u) for this key, u from a hash of key and shard.

    A key's scores do not depend on other shards: a new shard takes rows only
    into itself, a removed one gives up only its own, and a changed weight moves
    rows only to or from its shard. Ties go to the higher shard number. A null
    key hashes as the empty text.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0; leave a shard out to empty it")
    scores = [F.struct((F.lit(-float(w)) / F.log(_unit(text, F.lit(str(s))))).alias("score"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def slots(rows: DataFrame, shard: str, order: list[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """`rows` with `slot`: a place in its shard, gapless from 0.

    Rows are ordered by the hash of their `order` columns, then by these. The
    hash's value cuts each shard into pieces of about `piece_rows` rows, which
    are numbered side by side; a piece starts where the counts before it end.
    Rows alike in all `order` columns are interchangeable and first counted, so a
    third of all rows being copies of one row crowds no task.
    """
    same = [shard, *order]
    counted = rows.groupBy(*same).agg(F.count("*").alias("__n"))
    counted = counted.withColumn("__u", _unit(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    counted = written(counted, "counted")
    total = counted.agg(F.sum("__n")).first()[0] or 0
    pieces = max(1, -(-total // piece_rows))
    counted = counted.withColumn("__piece", F.floor(F.col("__u") * pieces))
    sizes = counted.groupBy(shard, "__piece").agg(F.sum("__n").alias("__size"))
    before = Window.partitionBy(shard).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "__piece", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(shard, "__piece").orderBy("__u", *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(offsets, [shard, "__piece"])
    placed = placed.withColumn("__first", F.col("__offset") + F.col("__before"))
    # many copies: first cut into runs, dealt out, then into rows
    runs = placed.select(*same, "__n", "__first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(piece_rows).cast("bigint"))).alias("__run"))
    runs = runs.repartition(*same, "__run")
    last = F.least(F.col("__run") + piece_rows, F.col("__n")) - 1
    return runs.select(*same, F.explode(F.sequence(F.col("__first") + F.col("__run"), F.col("__first") + last)).alias("slot"))


def shard_documents(docs: DataFrame, shards: int, weights: Mapping[int, float] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of `docs`.

    The id and the shard count decide (law `key`): rows with one id, null
    included, share a shard. `grown_shard` is the shard with one more of weight
    1. size: UTF-8 bytes of the text and 8; a null text has none and the
    crc32 of nothing, 0. Repeated rows have slots of their own. Other columns
    are not read; an empty table gives an empty result.
    """
    weights = dict(weights or {s: 1.0 for s in range(shards)})
    grown = {**weights, shards: 1.0}
    body = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column).alias("doc_id"), (F.octet_length(body).cast("bigint") + 8).alias("size"), F.crc32(body).alias("text_crc32"))
    rows = rows.select("*", rendezvous_shard(F.col("doc_id"), weights).alias("shard"))
    placed = slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", rendezvous_shard(F.col("doc_id"), grown).alias("grown_shard"))


def _sql_unit(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, {_DIGITS}))::bigint)::double + 0.5) / {1 << 52}::double"


#: DuckDB has no crc32: it is folded byte by byte over the hexadecimal text, two table steps of four bits each.
_CRC = """CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
    string_split_regex(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g'), ' ')[:octet_length(encode(text))], lambda h: ('0x' || h)::bigint)),
    lambda c, b: xor(xor(xor(c, b) >> 4, t[(xor(c, b) & 15) + 1]) >> 4, t[(xor(xor(c, b) >> 4, t[(xor(c, b) & 15) + 1]) & 15) + 1]))) END"""


def shard_sql(shards: int) -> str:
    """The rows of `shard_documents` with equal weights, as DuckDB SQL."""
    best = lambda n: "arg_max(s, -1.0 / ln(u)) FILTER (s < " + str(n) + ")"
    step = "list_transform(range(16), lambda n: list_reduce([n, 1, 1, 1, 1], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    return f"""
WITH bits AS (SELECT {step} AS t),
rows AS (SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, {_CRC} AS text_crc32 FROM documents, bits),
units AS (SELECT r, s, {_sql_unit("coalesce(doc_id::varchar, '') || ':' || s")} AS u FROM rows, range({shards + 1}) AS x(s)),
chosen AS (SELECT r, {best(shards)}::int AS shard, {best(shards + 1)}::int AS grown_shard FROM units GROUP BY r)
SELECT doc_id, size::bigint AS size, text_crc32::bigint AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY {_sql_unit("coalesce(doc_id::varchar, '') || ':' || size || ':' || text_crc32")}, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM rows JOIN chosen USING (r)"""
