"""MinHash near-duplicates: universal hash minima, banding, verification on whole sets, components.

How candidates are found without an unbounded group: every band bucket is cut
into blocks of about `BLOCK` members, each with the bucket's least member added.
A block hands on a maximum spanning forest of its pairs with agreeing signatures,
so no more pairs than members; blocks of one bucket that are not joined this way
are compared with each other, and again hand on a forest. The forests' components
are the groups inside which links can be. Forest pairs are verified on whole
shingle sets. Groups that the verified links leave in several parts are then
settled: blocks of their members meet, with their sets, and every pair of
different parts with agreeing signatures is verified there. So no pair is given
up, copies of one text cost one link, and no list of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.components import components
from eventlake.llm.tables import alone, bit_filter, in_filter, release, slices, text_column, text_key, with_fields, written
from eventlake.llm.words import common, distinct_counts, distinct_sorted, line_offsets, mix, sequence_keys, shingle_hashes, word_hashes

#: Members of a block, on average.
BLOCK = 48
#: Members whose blocks one task compares.
BLOCK_ROWS = 5_000
#: Pairs of members that are compared at a time.
PAIRS = 1 << 16
#: Bound of the number of minima.
_MOST = 256

_random = np.random.default_rng(75)
_A = _random.integers(0, 1 << 63, _MOST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, _MOST, dtype=np.uint64)
_FOLD = _random.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Banding:
    """`bands` of `rows` minima each, for units (whole texts, or their lines) of `least_words` words or more."""

    bands: int
    rows: int
    lines: bool = False
    least_words: int = 1

    @property
    def minima(self) -> int:
        return self.bands * self.rows


#: Whole texts: a pair at a similarity of 0.75 shares no band with a probability of 5 in a million.
TEXTS = Banding(32, 4)


def minima(hashes: np.ndarray, counts: np.ndarray, number: int) -> np.ndarray:
    """`number` universal hash minima (32 bits each) of every row of `counts` hashes; rows need one at least."""
    starts = np.cumsum(counts) - counts
    keys = hashes >> np.uint64(32)
    out = np.empty((len(counts), number), np.uint64)
    values = np.empty_like(keys)
    for i in range(number):
        np.multiply(keys, _A[i], out=values)
        values += _B[i]
        out[:, i] = np.minimum.reduceat(values, starts)
    return out >> np.uint64(32)


def _bands(least: np.ndarray, banding: Banding) -> np.ndarray:
    """One 64-bit key for each band of a signature, different between bands."""
    grouped = least.reshape(len(least), banding.bands, banding.rows)
    total = (grouped * _FOLD[: banding.rows]).sum(axis=2, dtype=np.uint64)
    return mix(total + np.arange(1, banding.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(rows.tobytes())])


@dataclass(frozen=True)
class _Units:
    """The units of a slice of texts that have enough words: row, number in the row, key, and shingles one after another."""

    row: np.ndarray
    no: np.ndarray
    keys: np.ndarray
    hashes: np.ndarray
    made: np.ndarray


def _units(data: np.ndarray, offsets: np.ndarray, banding: Banding, seen: np.ndarray | None = None) -> _Units:
    """With `seen`, a `bit_filter` of first halves of keys, only the units whose key may be there; shingles are made for these alone."""
    if banding.lines:
        at, row, no = line_offsets(data, offsets)
    else:
        at, row = offsets, np.arange(len(offsets) - 1)
        no = np.zeros(len(row), np.int64)
    words, counts, _, _ = word_hashes(data, at)
    wanted = counts >= max(1, banding.least_words)
    if not wanted.all():
        words, counts, row, no = words[np.repeat(wanted, counts)], counts[wanted], row[wanted], no[wanted]
    keys = sequence_keys(words, counts)
    if seen is not None:
        hit = in_filter(seen, np.ascontiguousarray(keys[:, 0]))
        words, counts, row, no, keys = words[np.repeat(hit, counts)], counts[hit], row[hit], no[hit], keys[hit]
    hashes, made = shingle_hashes(words, counts)
    return _Units(row, no, keys, hashes, made)


def _signatures(banding: Banding):
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = [c for c in batch.schema.names if c != "__text"]
            data, offsets = text_column(batch.column("__text"))
            for first, end in slices(offsets):
                units = _units(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], banding)
                if not len(units.row):
                    continue
                least = minima(units.hashes, units.made, banding.minima)
                sizes = distinct_counts(units.hashes, units.made)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(least) + 1, dtype=np.int32) * banding.bands), pa.array(_bands(least, banding).view(np.int64).ravel()))
                rows = pa.array(units.row + first)
                yield pa.record_batch(
                    [*[batch.column(c).take(rows) for c in carried], pa.array(units.no), _binary(units.keys), pa.array(sizes, pa.int64()), _binary(least.astype(np.uint8)), bands],
                    names=[*carried, "no", "key", "n", "sig", "bands"],
                )
        release()

    return signatures


def signed_units(docs: DataFrame, banding: Banding, carried: list[str], text_column: str = "text") -> DataFrame:
    """The carried columns, no, key, n, sig, bands of every unit of `docs` with enough words, as a written table."""
    rows = docs.select(*carried, F.col(text_column).alias("__text"))
    shape = with_fields(rows, carried, "no bigint, key binary, n bigint, sig binary, bands array<bigint>")
    return written(rows.mapInArrow(_signatures(banding), shape), "signatures")


def _colliding(seen: np.ndarray):
    """(bucket, key) of the bands whose bucket may have other members."""

    def colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bands = batch.column("bands")
            flat = bands.flatten().to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(in_filter(seen, flat))
            rows = hit // (len(flat) // batch.num_rows)
            yield pa.record_batch([pa.array(flat[hit]), batch.column("key").take(pa.array(rows))], names=["bucket", "key"])
        release()

    return colliding


def _sets(banding: Banding, seen: np.ndarray):
    """(key, shingles): sorted distinct shingle hashes of the units whose key may be wanted."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch.column("__text"))
            for first, end in slices(offsets):
                units = _units(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], banding, seen)
                if len(units.row):
                    ends = np.cumsum(units.made)
                    values = [distinct_sorted(units.hashes[e - m : e]).tobytes() for e, m in zip(ends, units.made, strict=True)]
                    yield pa.record_batch([_binary(units.keys), pa.array(values, pa.binary())], names=["key", "shingles"])
        release()

    return sets


class _Parts:
    """Parts of a block's members that are joined pair by pair."""

    def __init__(self, names: list) -> None:
        number = {name: i for i, name in enumerate(dict.fromkeys(names))}
        self.part = np.array([number[name] for name in names])
        self.up = list(range(len(number)))

    def top(self, member: int) -> int:
        x = int(self.part[member])
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.top(a)] = self.top(b)


def _agreeing(members: list[dict], parts: _Parts, least: float, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of members of different parts whose signatures agree in a share of `least`, the most similar first."""
    sig = np.frombuffer(b"".join(m["sig"] for m in members), np.uint8).reshape(len(members), -1)
    n = np.array([m["n"] for m in members], np.float64)
    similar = np.stack([(sig == s).mean(axis=1) for s in sig])
    # sizes alone rule a pair out
    similar[100 * np.minimum(n[:, None], n[None, :]) < percent * np.maximum(n[:, None], n[None, :])] = -1
    a, b = np.nonzero(np.triu(similar >= least, 1) & (parts.part[:, None] != parts.part[None, :]))
    for k in np.lexsort((b, a, -similar[a, b])):
        yield int(a[k]), int(b[k])


def _links_of_blocks(least: float, percent: int):
    """A maximum spanning forest of the agreeing pairs of each block that are links on whole sets."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                # a member listed twice (the bucket's least in its own block) counts once
                members = list({m["key"]: m for m in batch.column("members")[at].as_py()}.values())
                parts = _Parts([m["root"] for m in members])
                if len(parts.up) < 2:
                    continue
                sets: dict[int, np.ndarray] = {}
                left, right = [], []
                for a, b in _agreeing(members, parts, least, percent):
                    if parts.top(a) == parts.top(b):
                        continue
                    for m in (a, b):
                        if m not in sets:
                            sets[m] = np.frombuffer(members[m]["shingles"], np.uint64)
                    both = common(sets[a], sets[b])
                    if 100 * both < percent * (len(sets[a]) + len(sets[b]) - both):
                        continue
                    parts.join(a, b)
                    x, y = sorted((members[a]["key"], members[b]["key"]))
                    left.append(x), right.append(y)
                if left:
                    yield pa.record_batch([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
        release()

    return links


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The values of a binary column without nulls, all of `width` bytes, as rows of a matrix."""
    first = column.offset * width
    return np.frombuffer(column.buffers()[2], np.uint8)[first : first + len(column) * width].reshape(-1, width)


def _numbers(keys: np.ndarray) -> np.ndarray:
    """A number for each row of 16 bytes, equal for equal rows and in their order."""
    halves = keys.view(">u8").astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    halves = halves[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate(([False], (halves[1:] != halves[:-1]).any(axis=1))))
    return out


@dataclass(frozen=True)
class _Members:
    """The members of a batch of blocks, one block after another; one listed twice in a block (the bucket's least) counts once."""

    keys: np.ndarray
    number: np.ndarray
    root: np.ndarray
    n: np.ndarray
    sig: np.ndarray
    block: np.ndarray
    sizes: np.ndarray


def _members(lists: pa.Array) -> _Members:
    flat, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
    keys, sig = _fixed(flat.field("key"), 16), flat.field("sig")
    number, root = _numbers(keys), _numbers(_fixed(flat.field("root"), 16))
    block = np.repeat(np.arange(len(counts)), counts)
    at = np.sort(np.unique(block * (len(keys) + 1) + number, return_index=True)[1])
    n = flat.field("n").to_numpy(zero_copy_only=False)
    sig = _fixed(sig, len(sig[0].as_buffer()))
    # a root has a number of its own in each block
    root = block * (len(keys) + 1) + root
    return _Members(keys[at], number[at], root[at], n[at], sig[at], block[at], np.bincount(block[at], minlength=len(counts)))


def _ranges(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of blocks that have about `PAIRS` pairs of members together, or of one block."""
    pairs = np.concatenate(([0], np.cumsum(sizes * (sizes - 1) // 2)))
    first = 0
    while first < len(sizes):
        end = max(first + 1, int(np.searchsorted(pairs, pairs[first] + PAIRS, side="right")) - 1)
        yield first, end
        first = end


def _all_agreeing(members: _Members, first: int, end: int, least: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs as of `_agreeing`, of a range of blocks, block by block."""
    starts = np.cumsum(members.sizes) - members.sizes
    left, right = [], []
    for size in np.unique(members.sizes[first:end]):
        own = starts[first:end][members.sizes[first:end] == size][:, None]
        a, b = np.triu_indices(size, 1)
        left.append((own + a).ravel()), right.append((own + b).ravel())
    a, b, n = np.concatenate(left), np.concatenate(right), members.n
    may = (members.root[a] != members.root[b]) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
    a, b = a[may], b[may]
    similar = (members.sig[a] == members.sig[b]).sum(axis=1) / members.sig.shape[1]
    a, b, similar = a[similar >= least], b[similar >= least], similar[similar >= least]
    order = np.lexsort((b, a, -similar, members.block[a]))
    return a[order], b[order]


def _forests_of_blocks(least: float, percent: int):
    """A maximum spanning forest of the agreeing pairs of each block; most blocks are small, so many are compared at a time."""

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            members = _members(batch.column("members"))
            for first, end in _ranges(members.sizes):
                a, b = _all_agreeing(members, first, end, least, percent)
                # the one pair of a block needs no choice
                chosen = np.bincount(members.block[a], minlength=end)[members.block[a]] == 1
                others = np.flatnonzero(~chosen)
                if len(others):
                    start = int(members.sizes[:first].sum())
                    parts = _Parts(members.root[start : start + int(members.sizes[first:end].sum())].tolist())
                    for k, x, y in zip(others.tolist(), (a[others] - start).tolist(), (b[others] - start).tolist(), strict=True):
                        if parts.top(x) != parts.top(y):
                            parts.join(x, y)
                            chosen[k] = True
                a, b = a[chosen], b[chosen]
                turned = members.number[a] > members.number[b]
                if len(a):
                    yield pa.record_batch([_binary(members.keys[np.where(turned, b, a)]), _binary(members.keys[np.where(turned, a, b)])], names=["a", "b"])
        release()

    return forests


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = common(a, b)
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])
        release()

    return confirm


def _first_half(key: str):
    """The first eight bytes of a key as the long that NumPy reads from them: the low byte comes first."""
    total = F.lit(0).cast("bigint")
    for k in range(8):
        byte = F.conv(F.hex(F.substring(key, k + 1, 1)), 16, 10).cast("bigint")
        total = total.bitwiseOR(F.shiftleft(byte, 8 * k))
    return total


def _sets_of(keys: DataFrame, docs: DataFrame, banding: Banding, text_column: str) -> DataFrame:
    """(key, shingles) of some keys, from another pass over the texts, so that no text is shuffled."""
    rows = keys.count()
    wanted = written(keys, "wanted", rows)
    seen = bit_filter(wanted.select(_first_half("key").alias("half")))
    made = docs.select(F.col(text_column).alias("__text")).mapInArrow(_sets(banding, seen), "key binary, shingles binary")
    sets = written(made.groupBy("key").agg(F.first("shingles").alias("shingles")), "sets", 2 * rows, BLOCK_ROWS)
    return written(sets.join(wanted, "key", "left_semi"), "sets", rows, BLOCK_ROWS)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    first = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
    both = first.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    return written(both.select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a binary, b binary"), "links", pairs.count(), BLOCK_ROWS)


def _block_pairs(members: DataFrame, carried: list[str], rows: int) -> DataFrame:
    """(members): all pairs of blocks of each group that has several roots, but for those inside one root.

    members: group, key, root and the carried columns. A root with many members
    in a group has blocks of its own; the others share blocks.
    """
    large = F.col("c") >= BLOCK
    of_group = Window.partitionBy("group")
    sizes = members.groupBy("group", "root").agg(F.count("*").alias("c"))
    sizes = sizes.select("*", F.count("*").over(of_group).alias("roots"), F.sum(F.when(~large, F.col("c"))).over(of_group).alias("small"))
    placed = members.join(written(sizes.where("roots > 1"), "sizes", rows), ["group", "root"])
    alone = F.when(large, F.col("root")).alias("alone")
    share = F.when(large, F.pmod(F.xxhash64("key"), F.ceil(F.col("c") / BLOCK))).otherwise(F.pmod(F.xxhash64("root"), F.ceil(F.col("small") / BLOCK)))
    blocks = placed.groupBy("group", alone, share.alias("share")).agg(F.collect_list(F.struct("key", "root", *carried)).alias("members"))
    blocks = written(blocks.withColumn("block", F.xxhash64(F.coalesce("alone", F.lit(b"")), "share")), "blocks", rows, BLOCK_ROWS)
    heads = blocks.select("group", "block", "alone")
    others = heads.select("group", F.col("block").alias("other"), F.col("alone").alias("other_alone"))
    pairs = heads.join(others, "group").where("block <= other and not coalesce(alone = other_alone, false)")
    left = pairs.select("group", "block", "other").join(blocks.select("group", "block", "members"), ["group", "block"])
    right = blocks.select("group", F.col("block").alias("other"), F.col("members").alias("others"))
    met = left.join(right, ["group", "other"])
    return met.select(F.when(F.col("block") == F.col("other"), F.col("members")).otherwise(F.concat("members", "others")).alias("members"))


def similar_links(signed: DataFrame, docs: DataFrame, banding: Banding, percent: int, text_column: str = "text") -> DataFrame:
    """(a, b): links that hold the components of all keys together. signed: the `signed_units` of docs."""
    # buckets are counted by their number alone, and only rows of shared buckets are shuffled with their keys
    counts = signed.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size"))
    shared = written(counts.where("size > 1").select("bucket"), "shared-buckets")
    placed = signed.select("key", "bands").mapInArrow(_colliding(bit_filter(shared)), "bucket bigint, key binary").distinct()
    placed = written(placed, "placed")
    rows = placed.count()
    buckets = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("key").alias("least"))
    buckets = written(buckets.where("size > 1"), "buckets", rows)
    members = written(placed.join(buckets, "bucket").select("bucket", "key", "size", "least"), "members", rows)
    keys = written(members.select("key").distinct(), "keys", rows)
    signs = written(signed.select("key", "n", "sig").join(keys, "key").groupBy("key").agg(F.first("n").alias("n"), F.first("sig").alias("sig")), "signs", rows)
    # signatures agree by chance in one of 256 bytes; five deviations below the threshold
    share = percent / 100
    least = share - 5 * (share * (1 - share) / banding.minima) ** 0.5
    pair = "a binary, b binary"
    member = F.struct("key", F.col("key").alias("root"), "n", "sig").alias("m")
    blocks_of = F.ceil(F.col("size") / BLOCK)
    share_of = F.pmod(F.xxhash64("key"), blocks_of).cast("int").alias("share")
    every_share = F.explode(F.sequence(F.lit(0), (blocks_of - 1).cast("int"))).alias("share")
    anchors = buckets.where(F.col("size") > BLOCK).select("bucket", every_share, F.col("least").alias("key"))
    spread = members.select("bucket", share_of, "key").unionAll(anchors).join(signs, "key")
    blocks = spread.groupBy("bucket", "share").agg(F.collect_list(member).alias("members"))
    pairs = written(blocks.select("members").mapInArrow(_forests_of_blocks(least, percent), pair).distinct(), "pairs", rows, BLOCK_ROWS)
    groups = components(pairs).withColumnRenamed("node", "key")
    # blocks of one bucket that hold different groups
    large = members.where(F.col("size") > BLOCK).select(F.col("bucket").alias("group"), "key").join(groups, "key", "left")
    large = written(large.withColumn("root", F.coalesce("root", "key")), "large-buckets", rows)
    if not large.isEmpty():
        across = written(_block_pairs(large.join(signs, "key"), ["n", "sig"], rows).mapInArrow(_forests_of_blocks(least, percent), pair).distinct(), "pairs")
        if not across.isEmpty():
            pairs = pairs.unionAll(across)
            groups = components(pairs).withColumnRenamed("node", "key")
    sets = _sets_of(groups.select("key"), docs, banding, text_column)
    links = _verified(pairs, sets, percent)
    roots = components(links).select(F.col("node").alias("key"), F.col("root").alias("part"))
    # groups of three or more that are not one part yet; the one pair of two is verified already
    parts = written(groups.join(roots, "key", "left").select(F.col("root").alias("group"), "key", F.coalesce("part", "key").alias("root")), "parts", rows)
    of_group = parts.groupBy("group", "root").agg(F.count("*").alias("c")).groupBy("group").agg(F.count("*").alias("parts"), F.sum("c").alias("c"))
    unsettled = written(of_group.where("parts > 1 and c > 2").select("group"), "unsettled", rows)
    if unsettled.isEmpty():
        return links
    held = parts.join(unsettled, "group").join(signs, "key").join(sets, "key")
    more = _block_pairs(held, ["n", "sig", "shingles"], rows).mapInArrow(_links_of_blocks(least, percent), pair).distinct()
    return links.unionAll(written(more, "links"))


def component_of_keys(links: DataFrame) -> DataFrame:
    """(key, root) of every linked key."""
    return components(links).withColumnRenamed("node", "key")


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 75) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two texts are linked when 100 * intersection >= `percent` * union of their
    sets of 5-word shingles (words lower-cased in A-Z; a text of fewer words is
    one shingle). Candidates share one of 32 bands of 4 minima; every link is
    confirmed on whole sets. component_id is the least id reachable.

    Texts without words (null, empty, white space) are linked with nothing: each
    row is its own component. Rows of equal word sequences are one node. Null
    ids are passed over by the least id; a component of null ids alone has a null
    component_id, and its rows are kept. Rows with the same id are each reported.
    Other columns of `docs` are not read. An empty table gives an empty result.
    """
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    signed = signed_units(named, TEXTS, ["id"])
    roots = alone(lambda: component_of_keys(similar_links(signed, named, TEXTS, percent)))
    classes = signed.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("rows"))
    classes = written(classes.join(roots, "key", "left"), "classes")
    lowest = written(classes.where("root is not null").groupBy("root").agg(F.min("id").alias("lowest")), "lowest")
    of_key = classes.join(lowest, "root", "left").select("key", F.coalesce("lowest", "id").alias("component_id"))
    found = signed.select("id", "key", "n").join(written(of_key, "component-of"), "key").select("id", "n", "component_id")
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    bare = named.where(~has_word).select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("component_id"))
    out = found.unionAll(bare).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row of each component of near-duplicates (columns doc_id and text decide), with all columns.

    Of a component the row with the least doc_id stays (null ids last), then
    that with the least text key; of rows repeated in both, any one. Texts
    without words stay, each of them.
    """
    named = docs.select(F.col("doc_id").alias("id"), text_key("text").alias("text_key"), "text")
    signed = signed_units(named, TEXTS, ["id", "text_key"])
    roots = alone(lambda: component_of_keys(similar_links(signed, named, TEXTS, percent)))
    place = F.struct(F.col("id").isNull().alias("bare"), "id", "text_key").alias("place")
    first = signed.select("key", place).groupBy("key").agg(F.min("place").alias("place")).join(roots, "key", "left")
    first = written(first.select("key", F.coalesce("root", "key").alias("root"), "place"), "first-of-key")
    kept = written(first.groupBy("root").agg(F.min("place").alias("kept")), "first-of-component")
    known = written(first.select("key", "root").join(kept, "root").select("key", "kept"), "kept")
    rows = signed.select("key", place).join(known, "key")
    removed = rows.where("place <> kept").select(F.xxhash64("place.id", "place.text_key").alias("__h"), F.col("place.id").alias("__id"), F.col("place.text_key").alias("__t")).distinct()
    again = signed.groupBy("id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("id", "text_key").alias("__h"), F.col("id").alias("__id"), F.col("text_key").alias("__t"))
    removed, again = written(removed, "removed"), written(again, "repeated")
    own, text = F.col("doc_id"), text_key("text")
    same = (F.xxhash64(own, text) == F.col("__h")) & own.eqNullSafe(F.col("__id")) & text.eqNullSafe(F.col("__t"))
    left = docs.join(removed, same, "left_anti")
    if again.isEmpty():
        return left
    once = left.join(again, same, "left_semi").withColumn("__t", text_key("text")).dropDuplicates(["doc_id", "__t"]).drop("__t")
    return left.join(again, same, "left_anti").unionByName(once)
