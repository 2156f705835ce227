"""Byte-level BPE: overlapping chunks of long texts, stitched where their pre-token boundaries meet."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import text_key, with_fields, written

#: Characters of a chunk, and of its overlap with the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: A boundary closer to a chunk's end than this may depend on what follows the chunk.
LOOKAHEAD = 4


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in _ranks(path).items()}


@lru_cache(maxsize=4)
def _boundaries(pattern: str) -> regex.Pattern:
    # white space as in the tokenizer's own pattern engine: the Unicode property
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _id_lists(lists: list[list[int]]) -> pa.Array:
    at = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))


def encode_batches(path: str, pattern: str, keys: list[str], rows_at_once: int = 256):
    """Batches of texts as batches of `keys` and token_ids, each text in one piece; null is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _encoding(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(first, rows_at_once)
                ids = [one.encode_ordinary(text or "") for text in part.column("text").to_pylist()]
                yield pa.record_batch([*[part.column(k) for k in keys], _id_lists(ids)], names=[*keys, "token_ids"])

    return encode


def _chunks(size: int, overlap: int):
    """A row for each chunk of a text; chunks end `overlap` characters after the next one's start."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("text_key"), batch.column("text"), strict=True):
                whole = text.as_py()
                starts = list(range(0, len(whole), size))
                for first in range(0, len(starts), 64):
                    own = starts[first : first + 64]
                    yield pa.record_batch(
                        [pa.array([key.as_py()] * len(own), pa.binary()), pa.array(range(first, first + len(own)), pa.int64()), pa.array(own, pa.int64()), pa.array([s + size >= len(whole) for s in own]), pa.array([whole[s : s + size + overlap] for s in own])],
                        names=["text_key", "no", "start", "last", "text"],
                    )

    return chunks


def _bounds(pattern: str, size: int, overlap: int):
    """The pre-token boundaries of each chunk inside its overlap with the one before and the one after."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _boundaries(pattern)
        for batch in batches:
            head, tail = [], []
            for text, start in zip(batch.column("text").to_pylist(), batch.column("start").to_pylist(), strict=True):
                at = np.array([m.start() for m in pieces.finditer(text)], np.int64)
                at = at[at <= len(text) - LOOKAHEAD]
                head.append((at[at < overlap] + start).tolist())
                tail.append((at[at >= size] + start).tolist())
            yield pa.record_batch([*[batch.column(c) for c in ("text_key", "no", "start", "last", "text")], pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))], names=["text_key", "no", "start", "last", "text", "head", "tail"])

    return bounds


def pieces_of(texts: DataFrame, pattern: str, chunk: int, overlap: int, tasks: int | None = None) -> DataFrame:
    """(text_key, no, text): whole texts cut at true pre-token boundaries. texts: distinct text_key, text.

    A match depends on nothing before its start, so from a boundary that two
    overlapping chunks share they go on alike: each text is cut at the first
    such boundary of every overlap. A text that has an overlap without one (a
    run of letters longer than the overlap) is a single piece.
    """
    shape = "text_key binary, no bigint, start bigint, last boolean, text string"
    cut_up = texts.select("text_key", "text").mapInArrow(_chunks(chunk, overlap), shape)
    spread = cut_up.repartition(*([tasks] if tasks else []), "text_key", "no")
    bound = written(spread.mapInArrow(_bounds(pattern, chunk, overlap), shape + ", head array<bigint>, tail array<bigint>"), "chunks")
    of_text = Window.partitionBy("text_key")
    ordered = of_text.orderBy("no")
    cuts = bound.select("text_key", "no", "last", F.array_min(F.array_intersect("tail", F.lead("head").over(ordered))).alias("end"))
    cuts = cuts.select("*", F.lag("end", 1, 0).over(ordered).alias("begin"), F.max(F.col("end").isNull() & ~F.col("last")).over(of_text).alias("whole"))
    cuts = written(cuts, "cuts")
    placed = bound.select("text_key", "no", "start", "text").join(cuts.where("not whole"), ["text_key", "no"])
    end = F.when(F.col("last"), F.length("text") + F.col("start")).otherwise(F.col("end"))
    parts = placed.select("text_key", "no", F.substring("text", (F.col("begin") - F.col("start") + 1).cast("int"), (end - F.col("begin")).cast("int")).alias("text"))
    undivided = texts.join(cuts.where("whole").select("text_key").distinct(), "text_key").select("text_key", F.lit(0).cast("bigint").alias("no"), "text")
    return parts.unionAll(undivided)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, token_ids): every whole text in the ids of a rank file, as the tokenizer's own library gives them.

    `ranks` is a file of base64 tokens and ranks that every worker can open, as
    an installed package. Texts of more than `chunk` characters are cut into
    overlapping chunks that are pre-tokenised in parallel, stitched where their
    boundaries meet, and encoded piece by piece; equal long texts are encoded
    once. Special tokens are not recognised: their strings are ordinary text.

    Null and empty texts have no ids (an empty list). Null, repeated ids and
    repeated rows come out as often as they went in. Other columns are not read.
    An empty table gives an empty result.
    """
    short, long = by_length(docs, id_column, text_column, chunk)
    kind = short.schema["doc_id"].dataType.simpleString()
    return short.mapInArrow(encode_batches(ranks, pattern, ["doc_id"]), f"doc_id {kind}, token_ids array<int>").unionAll(encode_long(long, ranks, pattern, chunk, overlap))


def by_length(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) of the rows whose text is one chunk or none, and of those with longer texts."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    return rows.where(~is_long), rows.where(is_long)


def encode_long(rows: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, token_ids) of texts (doc_id, text; none null or empty) that are cut into overlapping chunks."""
    keyed = rows.select("doc_id", text_key("text").alias("text_key"), "text")
    texts = keyed.groupBy("text_key").agg(F.first("text").alias("text"))
    pieces = pieces_of(texts, pattern, chunk, overlap)
    encoded = pieces.mapInArrow(encode_batches(ranks, pattern, ["text_key", "no"]), "text_key binary, no bigint, token_ids array<int>")
    # the ids of one text come together, no more than its own row holds anyway
    ordered = F.sort_array(F.collect_list(F.struct("no", "token_ids")))
    whole = written(encoded.groupBy("text_key").agg(F.flatten(F.transform(ordered, lambda x: x["token_ids"])).alias("token_ids")), "ids")
    return keyed.select("doc_id", "text_key").join(whole, "text_key").select("doc_id", "token_ids")


def _decode(ranks: str, keys: list[str]):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _tokens(ranks)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                raw = [None if ids is None else b"".join([one[i] for i in ids]) for ids in part.column("token_ids").to_pylist()]
                yield pa.record_batch([*[part.column(k) for k in keys], pa.array(raw, pa.binary())], names=[*keys, "bytes"])

    return decode


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows of `encoded` (doc_id, token_ids) with `bytes`, the tokens' raw bytes one after another; null for null ids."""
    return encoded.mapInArrow(_decode(ranks, encoded.columns), with_fields(encoded, encoded.columns, "bytes binary"))


def token_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document, by encoding and decoding it."""
    both = decode_documents(encode_documents(docs, ranks, pattern), ranks)
    joined = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
