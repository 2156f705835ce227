"""Exact top-k by inner product: vectors in vertical layout, scores added up dimension block by dimension block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import written

#: Vectors of a candidate block, queries of a query block, dimensions added at a time.
BLOCK, QUERIES, STEP = 4096, 128, 16
#: Query blocks that a task holds while candidate blocks go by.
GROUP = 64
#: Products of norms from here on may not be counted in 64 bits; a little less than 2**63, as norms are rounded.
LIMIT = 2.0**63 * (1 - 1e-6)


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null where the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(sound & vector.isNotNull(), F.transform(x, lambda v: F.floor(v * scale).cast("bigint")))


def _vertical(vectors: list[list[int]]) -> bytes:
    """Dimension after dimension, each the values of all vectors."""
    return np.ascontiguousarray(np.array(vectors, np.int64).T).tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of vectors of equal length: row numbers, ids and the values in vertical layout."""
    for batch in batches:
        groups, rows, ids, dims, columns = [], [], [], [], []
        for group, vectors in zip(batch.column("block").to_pylist(), batch.column("own").to_pylist(), strict=True):
            by_length: dict[int, list] = {}
            for vector in vectors:
                by_length.setdefault(len(vector["v"]), []).append(vector)
            for length, own in by_length.items():
                groups.append(group), dims.append(length), rows.append([r["row"] for r in own]), ids.append([r["id"] for r in own]), columns.append(_vertical([r["v"] for r in own]))
        lists = pa.list_(pa.int64())
        yield pa.record_batch([pa.array(groups, pa.int64()), pa.array(dims, pa.int32()), pa.array(rows, lists), pa.array(ids, lists), pa.array(columns, pa.binary())], names=["block", "dims", "rows", "ids", "columns"])


def branch_and_bound(queries: np.ndarray, columns: np.ndarray, k: int, banned: np.ndarray | None = None, ids: np.ndarray | None = None, floors: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (row) the places and scores of its k best columns of `columns` (dimensions x vectors), ties to the smaller id.

    After each block of dimensions a candidate's final score lies within the
    product of the masses (norms) that query and candidate have left. Candidates
    whose upper bound is below the k-th best lower bound are dropped, and the
    survivors are packed together when they are few. `floors`, a score for each
    query, says below what a column is of no use; such ones may be missing.
    """
    n_dims, n = columns.shape
    ids = np.arange(n) if ids is None else ids
    starts = list(range(0, n_dims, STEP))
    squares = [(columns[s : s + STEP].astype(np.float64) ** 2).sum(axis=0) for s in starts]
    left = [np.sqrt(sum(squares[i + 1 :], np.zeros(n))) for i in range(len(starts))]
    out = []
    for q, query in enumerate(queries):
        alive = np.arange(n) if banned is None or banned[q] < 0 else np.delete(np.arange(n), banned[q])
        score, held, at = np.zeros(len(alive), np.int64), columns, alive
        for i, s in enumerate(starts):
            block = held[s : s + STEP]
            score = score + query[s : s + STEP] @ (block if len(at) == block.shape[1] else block[:, at])
            mass = float(np.sqrt((query[s + STEP :].astype(np.float64) ** 2).sum()))
            if (len(alive) > k or floors is not None) and i + 1 < len(starts):
                # a little more than the exact bound, as norms are rounded
                slack = mass * left[i][alive] * (1 + 1e-9) + 1e-6
                floor = -np.inf if floors is None else floors[q]
                if len(alive) > k:
                    floor = max(floor, np.partition(score - slack, len(alive) - k)[len(alive) - k])
                keep = score + slack >= floor
                if not keep.all():
                    alive, score, at = alive[keep], score[keep], at[keep]
                    if len(at) * 4 < held.shape[1]:
                        held, at = np.ascontiguousarray(held[:, at]), np.arange(len(at))
        best = np.lexsort((ids[alive], -score))[:k]
        out.append((alive[best], score[best]))
    return out


class _Best:
    """The k best candidates so far of each query of a block, as rows of (score, id, row number)."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, k: int):
        self.rows, self.ids, self.k = rows, ids, k
        self.found = [np.zeros((0, 3), np.int64) for _ in rows]

    def floors(self) -> np.ndarray:
        """The score that a further candidate of each query must reach, or a little less, as great ones are rounded."""
        last = np.array([float(own[-1, 0]) if len(own) == self.k else -np.inf for own in self.found])
        return last - 1e-9 * np.abs(last)

    def add(self, found: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, ids: np.ndarray) -> None:
        for q, (places, scores) in enumerate(found):
            if len(places):
                both = np.concatenate([self.found[q], np.stack([scores, ids[places], rows[places]], axis=1)])
                self.found[q] = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[: self.k]]

    def batch(self) -> pa.RecordBatch:
        sizes, best = [len(own) for own in self.found], np.concatenate(self.found)
        columns = [np.repeat(self.rows, sizes), np.repeat(self.ids, sizes), best[:, 2], best[:, 1], best[:, 0]]
        return pa.record_batch([pa.array(c) for c in columns], names=["query_row", "query_id", "row", "vec_id", "score"])


def _search(k: int):
    """The k best candidates of each query row in a task's pairs of blocks; rows are known by their numbers, ids may repeat."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                dims, rows, ids = row["dims"].as_py(), row["rows"].values.to_numpy(), row["ids"].values.to_numpy()
                own = (row["query_block"].as_py(), dims)
                if own not in best:
                    best[own] = _Best(row["query_rows"].values.to_numpy().copy(), row["query_ids"].values.to_numpy().copy(), k)
                held = best[own]
                columns = np.frombuffer(row["columns"].as_buffer(), np.int64).reshape(dims, len(ids))
                queries = np.frombuffer(row["query_columns"].as_buffer(), np.int64).reshape(dims, len(held.ids)).T
                if _longest(columns) * _longest(queries.T) >= LIMIT:
                    raise ValueError("inner products of these vectors may lie beyond 63 bits: scale them down")
                place = {int(x): i for i, x in enumerate(rows)}
                banned = np.array([place.get(int(x), -1) for x in held.rows])
                held.add(branch_and_bound(np.ascontiguousarray(queries), columns, k, banned, ids, held.floors()), rows, ids)
        for held in best.values():
            yield held.batch()

    return search


def _longest(columns: np.ndarray) -> float:
    """The greatest norm of the vectors that stand in the columns."""
    return float(np.sqrt((columns.astype(np.float64) ** 2).sum(axis=0)).max(initial=0.0))


def _blocks(vectors: DataFrame, per_block: int, name: str) -> tuple[DataFrame, int]:
    """Packed blocks of about `per_block` vectors, and how many numbers they have."""
    vectors = written(vectors, name)
    blocks = max(1, -(-vectors.count() // per_block))
    grouped = vectors.groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("row", "id", "v")).alias("own"))
    return written(grouped.mapInArrow(_pack, "block bigint, dims int, rows array<bigint>, ids array<bigint>, columns binary"), f"{name}-blocks"), blocks


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query with every other row.

    Components become floor(scale * x). Query blocks meet every block of
    candidates: the stated query set against all rows, in blocks of bounded
    size. Each task reads a part of the candidate blocks and a group of query
    blocks where they lie, so pairs of blocks are neither shuffled nor broadcast,
    and gives k rows a query at most. Candidates dealt by their hash fill blocks
    alike whatever the ids are.

    Ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component take no part, nor do rows with a null id; a vector is
    compared with those of its own length, empty ones with empty ones at score
    0. Rows with the same id all take part, as candidates of one another too, and
    each that is a query has its own ranks. Scores are exact: where the norms of
    two blocks allow one beyond 63 bits, the search ends with an error. Other
    columns are not read; an empty table or a single vector gives an empty result.
    """
    sound = vectors.select(F.col(id_column).cast("bigint").alias("id"), whole_numbers(F.col(vector_column), scale).alias("v"), is_query.alias("query"))
    # rows are numbered as they are written, so the numbers stay
    sound = written(sound.where("id is not null and v is not null").withColumn("row", F.monotonically_increasing_id()), "vectors")
    candidates, _ = _blocks(sound.select("row", "id", "v"), BLOCK, "candidates")
    queries, n = _blocks(sound.where("query").select("row", "id", "v"), QUERIES, "queries")
    asked = queries.select("dims", F.col("block").alias("query_block"), F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), F.col("columns").alias("query_columns"))
    # the hint keeps the planner from broadcasting blocks, or from sorting them all by their number of dimensions
    grouped = asked.repartition(-(-n // GROUP), "query_block").hint("shuffle_replicate_nl")
    met = candidates.join(grouped, "dims").select("dims", "rows", "ids", "columns", "query_block", "query_rows", "query_ids", "query_columns")
    found = met.mapInArrow(_search(k), "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same rows as DuckDB SQL.
NEAREST_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.x) = 0 THEN 0 ELSE list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) END::bigint AS score
    FROM v q JOIN v c ON q.row <> c.row AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::int AS rank FROM s) WHERE rank <= 5"""
