"""Packing token ids into rows of fixed length by best-fit decreasing, for training input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from eventlake.llm.bpe import by_length, encode_batches, encode_long
from eventlake.llm.tables import written

#: Tokens of a packed row.
LENGTH = 2048
#: Tokens that are packed together; a task holds no more of them at a time.
GROUP_TOKENS = 1 << 21
#: Fills the end of a row; no token id.
PADDING = -1


class Capacities:
    """Segment tree over free capacities 0..length: how many bins have each, and the least one that is enough."""

    def __init__(self, length: int) -> None:
        self.leaves = 1
        while self.leaves <= length:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, free: int, number: int) -> None:
        self.bins[free].append(number)
        self._change(free, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """A bin of the least free capacity of at least `size`, removed; None if there is none."""
        node, count = size + self.leaves, self.count
        if not count[node]:
            # up to the first left child whose right neighbour holds bins, then down its left edge
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._change(free, -1)
        return free, self.bins[free].pop()

    def _change(self, free: int, by: int) -> None:
        node = free + self.leaves
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of places in `sizes`, each at most `length` in sum: the longest first, each into the fullest bin that has room."""
    tree, bins = Capacities(length), []
    for place in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[place])
        if found is None:
            free, number = length, len(bins)
            bins.append([])
        else:
            free, number = found
        bins[number].append(place)
        tree.add(free - sizes[place], number)
    return bins


def _pack(length: int, group_tokens: int, id_type: pa.DataType):
    def packed(group: list[tuple], first: int) -> pa.RecordBatch:
        bins = best_fit_decreasing([len(ids) for _, _, ids in group], length)
        task = TaskContext.get()
        base = ((task.partitionId() if task else 0) << 40) + first
        rows = np.full((len(bins), length), PADDING, np.int32)
        docs, parts, ends = [], [], []
        for row, own in zip(rows, bins, strict=True):
            at, marks = 0, [0]
            for place in own:
                ids = group[place][2]
                row[at : at + len(ids)] = ids
                at += len(ids)
                marks.append(at)
            docs.append([group[p][0] for p in own])
            parts.append([group[p][1] for p in own])
            ends.append(marks)
        raw = rows.astype("<i4").tobytes()
        width = 4 * length
        return pa.record_batch(
            [
                pa.array(range(base, base + len(bins)), pa.int64()),
                pa.array([m[-1] for m in ends], pa.int32()),
                pa.array(docs, pa.list_(id_type)),
                pa.array(parts, pa.list_(pa.int32())),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array([raw[i * width : (i + 1) * width] for i in range(len(bins))], pa.binary()),
            ],
            names=["pack_id", "n_tokens", "doc_ids", "parts", "cu_seqlens", "ids"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, made = [], 0, 0
        for batch in batches:
            tokens = batch.column("token_ids")
            flat, offsets = tokens.values.to_numpy(zero_copy_only=False), tokens.offsets.to_numpy()
            for row, doc in enumerate(batch.column("doc_id").to_pylist()):
                if not tokens[row].is_valid:
                    continue
                a, b = int(offsets[row]), int(offsets[row + 1])
                for part, start in enumerate(range(a, b, length)):
                    group.append((doc, part, flat[start : min(start + length, b)]))
                    held += len(group[-1][2])
                    if held >= group_tokens:
                        out = packed(group, made)
                        made += out.num_rows
                        group, held = [], 0
                        yield out
            # pieces kept for the next batch must not hold this one in memory
            group = [(d, p, ids.copy()) for d, p, ids in group]
        if group:
            yield packed(group, made)

    return pack


def pack_tokens(tokens: DataFrame, length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """pack_id, n_tokens, doc_ids, parts, cu_seqlens, ids: rows of `length` token ids without loss. tokens: doc_id, token_ids.

    A document longer than a row is split into parts of `length` tokens and a
    rest, numbered from 0. Each group of about `group_tokens` tokens of a
    partition is packed by itself, so nothing is shuffled and no task holds more.
    `ids` are little-endian 32-bit numbers, padded with -1; segment i of a row
    lies from cu_seqlens[i] to cu_seqlens[i + 1] and is part parts[i] of document
    doc_ids[i]; positions start anew at each (see `position_ids`).

    Documents without tokens (null or empty) have no segment. Null and repeated
    ids are listed as they are. An empty table gives no rows. `tokens` should be
    a table, so that a repeated task finds the same rows in the same order.
    """
    kind = tokens.schema["doc_id"].dataType
    return tokens.select("doc_id", "token_ids").mapInArrow(_pack(length, group_tokens, to_arrow_type(kind)), _shape(kind))


def _shape(kind: DataType) -> str:
    return f"pack_id bigint, n_tokens int, doc_ids array<{kind.simpleString()}>, parts array<int>, cu_seqlens array<int>, ids binary"


def pack_documents(docs: DataFrame, ranks: str, pattern: str, length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """As :func:`pack_tokens`, for the whole texts of `docs` (doc_id, text) in the ids of a rank file.

    A text of one chunk is encoded and packed by the same task, and its ids are
    not written in between; the ids of longer ones are stitched, written and then
    packed. A task numbers its packs by its own place among the tasks of both.
    `docs` should be a table, so that a repeated task finds the same rows in the
    same order. Null and empty texts have no segment.
    """
    short, long = by_length(docs)
    kind = short.schema["doc_id"].dataType
    encode, pack = encode_batches(ranks, pattern, ["doc_id"]), _pack(length, group_tokens, to_arrow_type(kind))
    packed = short.mapInArrow(lambda batches: pack(encode(batches)), _shape(kind))
    return packed.unionAll(pack_tokens(written(encode_long(long, ranks, pattern), "tokens"), length, group_tokens))


def position_ids(cu_seqlens: Column) -> Column:
    """The position of every token of a packed row in its segment."""
    ends = F.slice(cu_seqlens, F.lit(2), F.size(cu_seqlens) - 1)
    starts = F.slice(cu_seqlens, F.lit(1), F.size(cu_seqlens) - 1)
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.sequence(F.lit(0), b - a - 1)))


def resets(cu_seqlens: Column) -> Column:
    """The places in a packed row where positions start again at 0."""
    return F.slice(cu_seqlens, F.lit(1), F.size(cu_seqlens) - 1)


def write_packed(packed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes packed rows with their position resets as Parquet, the ids as raw binary."""
    packed.withColumn("resets", resets(F.col("cu_seqlens"))).write.mode(mode).parquet(path)
