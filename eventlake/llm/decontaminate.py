"""Benchmark decontamination by spaced seeds.

A seed is the hash of a few tokens at fixed distances; the tokens between them
are ignored, so a substituted token spoils only the seeds that look at it. Test
and training seeds are joined, and around every hit the two texts are laid side
by side and compared token by token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import slices, text_column, text_key, written
from eventlake.llm.words import letter_tokens, mix

#: Positions each mask looks at. Any 13 aligned tokens with two substitutions, and
#: any 8 with one, hold one of these seeds whole (a test tries all placings).
MASKS = ((0, 1, 2, 3, 5), (0, 1, 4, 5, 6))
#: Tokens of the overlap that tells a leak, or all of a shorter item; shorter items than LEAST are not looked for.
WINDOW, LEAST = 13, 8
#: Places of the filter of test seeds: its size does not grow with the test set.
FILTER_BITS = 24
#: Tokens kept on both sides of a hit.
MARGIN = WINDOW + 3

_random = np.random.default_rng(13)
_PLACE = _random.integers(0, 1 << 63, (len(MASKS), 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def allowed(tokens: int) -> int:
    """Substitutions that an overlap of so many tokens may have: one in six."""
    return tokens // 6


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes, counts, starts, ends = letter_tokens(data, offsets, (), 1, scripts=True)
    return np.ascontiguousarray(hashes[:, 0]), counts, starts, ends


def _seeds(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first token and row of every seed that lies in one row."""
    row_of = np.repeat(np.arange(len(counts)), counts)
    hashes, at = [], []
    for number, mask in enumerate(MASKS):
        n = len(words) - mask[-1]
        if n <= 0:
            continue
        total = words[mask[0] : mask[0] + n] * _PLACE[number, 0]
        for k, place in enumerate(mask[1:], 1):
            total += words[place : place + n] * _PLACE[number, k]
        inside = np.flatnonzero(row_of[:n] == row_of[mask[-1] :])
        hashes.append(mix(total[inside]))
        at.append(inside)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate(at)
    return np.concatenate(hashes), first, row_of[first]


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of the filter for each hash."""
    some = np.uint64((1 << FILTER_BITS) - 1)
    return (hashes & some).astype(np.int64), ((hashes >> np.uint64(32)) & some).astype(np.int64)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        words, counts, _, _ = _tokens(data, offsets)
        hashes, first, row = _seeds(words, counts)
        start = np.cumsum(counts) - counts
        wanted = counts[row] >= LEAST
        hashes, first, row = hashes[wanted], first[wanted], row[wanted]
        one, two = _bits(hashes)
        yield pa.record_batch([batch.column("item_key").take(pa.array(row)), pa.array(hashes.view(np.int64)), pa.array(first - start[row]), pa.array(one), pa.array(two)], names=["item_key", "seed", "item_at", "one", "two"])


def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        words, counts, _, _ = _tokens(data, offsets)
        ends = np.cumsum(counts)
        yield pa.record_batch([batch.column("item_key"), pa.array([words[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary())], names=["item_key", "item"])


_HIT = pa.struct([("seed", pa.int64()), ("at", pa.int64())])


def _regions(seen: np.ndarray):
    """The stretches of each text around seeds that pass the filter, with the seeds."""

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = lambda places: (seen[places >> 3] >> (places & 7).astype(np.uint8)) & 1
        for batch in batches:
            data, offsets = text_column(batch.column("text"))
            for begin, end in slices(offsets):
                part, at = data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
                words, counts, starts, ends = _tokens(part, at)
                hashes, first, row = _seeds(words, counts)
                one, two = _bits(hashes)
                hit = np.flatnonzero(test(one) & test(two))
                hit = hit[np.argsort(first[hit], kind="stable")]
                if not len(hit):
                    continue
                cut = np.flatnonzero((np.diff(first[hit]) > 2 * MARGIN) | (np.diff(row[hit]) > 0)) + 1
                row_start, row_end = np.cumsum(counts) - counts, np.cumsum(counts)
                out: list[list] = [[] for _ in range(6)]
                for group in np.split(hit, cut):
                    r = int(row[group[0]])
                    a, b = max(int(row_start[r]), int(first[group[0]]) - MARGIN), min(int(row_end[r]), int(first[group[-1]]) + MARGIN + WINDOW)
                    text = part[at[r] : at[r + 1]]
                    place = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
                    out[0].append(batch.column("text_key")[begin + r].as_py())
                    out[1].append(a - int(row_start[r]))
                    out[2].append(words[a:b].tobytes())
                    out[3].append(place[starts[a:b] - at[r]].tolist())
                    out[4].append(place[ends[a:b] - at[r]].tolist())
                    out[5].append([{"seed": int(h), "at": int(f) - a} for h, f in zip(hashes[group].view(np.int64), first[group], strict=True)])
                kinds = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(_HIT)]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["text_key", "region", "tokens", "starts", "ends", "hits"])

    return regions


def overlap(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """First and end token of `text` and equal tokens of the overlap with `item`, whose token j lies at text token j + shift.

    The overlap is the hull of all windows of WINDOW tokens (or of the whole
    item, if it is shorter) with no more than the allowed substitutions.
    """
    size = min(WINDOW, len(item))
    a, b = max(0, shift), min(len(text), len(item) + shift)
    if b - a < size:
        return None
    equal = text[a:b] == item[a - shift : b - shift]
    total = np.concatenate(([0], np.cumsum(equal)))
    good = np.flatnonzero(total[size:] - total[:-size] >= size - allowed(size))
    if not len(good):
        return None
    first, end = int(good[0]), int(good[-1]) + size
    return a + first, a + end, int(total[end] - total[first])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for row in batch.to_pylist():
            text, item = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["item"], np.uint64)
            found = overlap(text, item, row["shift"])
            if found:
                first, end, equal = found
                for x, value in zip(out, (row["text_key"], row["item_key"], row["starts"][first], row["ends"][end - 1], end - first, equal), strict=True):
                    x.append(value)
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["text_key", "item_key", "start", "end", "tokens", "equal"])


def _filter(seeds: DataFrame) -> np.ndarray:
    """The bits of all test seeds: at most 2**(FILTER_BITS - 6) numbers come to the driver, whatever the test set holds."""
    places = seeds.select(F.explode(F.array("one", "two")).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits"))
    found = words.toArrow()
    seen = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    seen[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return seen.view(np.uint8)


def leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_text_column: str = "text") -> DataFrame:
    """(text_key, item_key, start, end, tokens, equal): the longest overlap of each text of `docs` with each item.

    Keys are the texts' own (see `text_key`); start and end are character
    offsets of the text; equal of its `tokens` tokens are the item's. Tokens are
    runs of letters and digits, lower-cased in A-Z, and single characters of
    scripts without spaces. An overlap is a leak from 13
    aligned tokens with at most two substituted, or a whole shorter item with
    one in six; items of fewer than 8 tokens are not looked for. Null and empty
    texts, on either side, and an empty table give no rows.
    """
    search = _search(docs, benchmark, text_column, item_text_column)
    found = _confirmed(search, search.hits.join(search.seeds.select("seed", "item_key", "item_at"), "seed"))
    best = F.max(F.struct("equal", "tokens", -F.col("start"), "start", "end")).alias("best")
    return written(found.groupBy("text_key", "item_key").agg(best).select("text_key", "item_key", "best.start", "best.end", "best.tokens", "best.equal"), "leaks")


@dataclass(frozen=True)
class _Search:
    """Written tables: items' seeds and tokens, the texts' stretches around hits, and the hits (text_key, region, seed, at)."""

    seeds: DataFrame
    items: DataFrame
    regions: DataFrame
    hits: DataFrame


def _search(docs: DataFrame, benchmark: DataFrame, text_column: str, item_text_column: str) -> _Search:
    items = benchmark.select(text_key(item_text_column).alias("item_key"), F.col(item_text_column).alias("text")).where("text is not null").dropDuplicates(["item_key"])
    items = written(items, "items")
    seeds = written(items.mapInArrow(_item_seeds, "item_key binary, seed bigint, item_at bigint, one bigint, two bigint"), "item-seeds")
    whole = docs.select(text_key(text_column).alias("text_key"), F.col(text_column).alias("text")).where("text is not null")
    shape = "text_key binary, region bigint, tokens binary, starts array<bigint>, ends array<bigint>, hits array<struct<seed:bigint,at:bigint>>"
    found = written(whole.mapInArrow(_regions(_filter(seeds)), shape), "regions")
    # equal texts have equal regions
    regions = written(found.groupBy("text_key", "region").agg(*[F.first(c).alias(c) for c in ("tokens", "starts", "ends", "hits")]), "regions")
    hits = regions.select("text_key", "region", F.explode("hits").alias("hit")).select("text_key", "region", "hit.seed", "hit.at")
    tokens = items.mapInArrow(_item_tokens, "item_key binary, item binary")
    return _Search(seeds, written(tokens, "item-tokens"), regions, hits)


def _confirmed(search: _Search, met: DataFrame) -> DataFrame:
    """The overlaps among hits that have met an item's seed. met: text_key, region, at, item_key, item_at."""
    shifts = met.select("text_key", "region", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = written(shifts, "hits").join(search.regions.drop("hits"), ["text_key", "region"]).join(search.items, "item_key")
    return pairs.select("text_key", "item_key", "tokens", "starts", "ends", "item", "shift").mapInArrow(_verify, "text_key binary, item_key binary, start bigint, `end` bigint, tokens bigint, equal bigint")


def leaking_texts(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_text_column: str = "text") -> DataFrame:
    """(text_key): the texts of `docs` that overlap any item, by the rule of :func:`leaks`, each once.

    Each seed is first compared with the least of the items that hold it, which
    settles texts that share a phrase of many items; only texts that this leaves
    open meet all items of their seeds. So a phrase in every item does not make
    a pair for each text and item.
    """
    search = _search(docs, benchmark, text_column, item_text_column)
    least = search.seeds.groupBy("seed").agg(F.min(F.struct("item_key", "item_at")).alias("least"), F.count("*").alias("n"))
    least = written(least, "seed-items")
    first = search.hits.join(least.select("seed", "least.item_key", "least.item_at"), "seed")
    settled = written(_confirmed(search, first).select("text_key").distinct(), "leaking")
    # a seed of one item has been compared with all it has
    more = search.seeds.join(least.where("n > 1"), "seed").where(F.struct("item_key", "item_at") != F.col("least"))
    still = search.hits.join(settled, "text_key", "left_anti").join(more.select("seed", "item_key", "item_at"), "seed")
    return settled.unionAll(_confirmed(search, still).select("text_key").distinct())


def leaked_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, tokens, equal for every document and item that overlap; a row each for repeated ids."""
    found = leaks(docs, benchmark)
    rows = docs.select("doc_id", text_key("text").alias("text_key"))
    items = benchmark.select("item_id", text_key("text").alias("item_key"))
    return rows.join(found, "text_key").join(items, "item_key").select("doc_id", "item_id", "start", "end", "tokens", "equal")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose text (column text) overlaps no item; null texts stay."""
    bad = written(leaking_texts(docs, benchmark).select(F.col("text_key").alias("__leaked")), "leaked")
    return docs.join(bad, text_key("text") == F.col("__leaked"), "left_anti")
