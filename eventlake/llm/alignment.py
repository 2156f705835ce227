"""Two tokenizers' tokens of the same texts, aligned by bytes, and how common each pair of them is in the corpus.

Byte offsets where tokens of both end cut a text into groups; tokens of a group
are linked. Pairs of ids are counted by the documents that hold them linked:
distinct pairs get a minimal perfect hash, counts are vectors over its slots,
and a second pass aligns the documents again and looks the counts up.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventlake.llm.perfect_hash import PerfectHash
from eventlake.llm.tables import with_fields, written

#: Pairs go to buckets by their first id, so a bucket holds all pairs of its ids.
#: Of 50,257 and 32,000 ids it has at most 50 * 32,000 = 1.6 million, however large the corpus.
BUCKETS = 1024
#: UTF-8 bytes of text and rows of a chunk, whose documents share one look-up; one longer text is a chunk of its own.
CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 20_000
#: Partial counts of a bucket that are put together at a time.
FAN_IN = 16
#: Chunks whose pairs of one bucket are looked up together.
SHARD_CHUNKS = 4096
#: Characters of a text that are aligned at a time.
PIECE = 1 << 20
#: Ids of words that a task remembers, of both kinds together; it begins anew beyond them.
REMEMBERED = 4 << 20
#: Links of a group up to which they are listed one by one.
GROUP_LINKS = 4096

COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
CHUNKED = "chunk bigint, row bigint, piece bigint, a_ids binary, b_ids binary, bucket int, keys binary, counts binary"
PARTIAL = "bucket int, node bigint, keys binary, counts binary"
DICTIONARY = "bucket int, sizes binary, taken binary, keys binary, counts binary, best binary"
FOUND = "chunk bigint, keys binary, counts binary, best binary"

# Fixed value: how the first kind of tokenizer cuts a text before it merges bytes.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that the faster library's pattern engine may be too long for.
LONG_SPACE = re.compile(r"\s{1000,}")
#: A space between two other characters. No token of either kind reaches over the place before it:
#: the first kind's pre-tokens begin there, the second kind's pieces have their space in front.
CUT = re.compile(r" (?<=\S )(?=\S)")


# Tokenizers


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are and the others, in order, as characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        plain = _bytes_of_characters()
        ranks = {bytes(plain[c] for c in entry): k for entry, k in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = {k: raw for raw, k in ranks.items()}
        # merges in the order of their ids are ranks, which this library applies in a fifth of the time
        self.merged = tiktoken.Encoding("a", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}) if _in_order(byte_level) else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError(f"pieces of {pieces} have spaces inside or at their end")
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(k) else n.replace("▁", " ").encode() for k, n in enumerate(names)]
        self.a_lengths = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_lengths[list(self.a_bytes)] = [len(raw) for raw in self.a_bytes.values()]
        self.b_lengths = np.array([len(raw) for raw in self.b_bytes], np.int64)
        self.id_type = np.uint16 if max(len(self.a_lengths), len(names)) <= 1 << 16 else np.uint32
        self.words = Words(self)
        #: What ids look like before a comma, and before what ends their kind's part of a group.
        self.shown = [f"{k}{end}" for size, ends in ((len(self.a_lengths), ",|"), (len(names), ",;")) for k in range(size) for end in ends]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both kinds of a text after a space; none if either kind's bytes are not just that."""
        spaced = f" {text}"
        if self.merged is None or LONG_SPACE.search(spaced):
            a = self.a.encode(spaced, add_special_tokens=False).ids
            if b"".join(map(self.a_bytes.__getitem__, a)) != spaced.encode():
                return None
            a = np.array(a, np.int64)
        else:
            a = self.merged.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)  # ranks hold all bytes, so nothing is lost
        b = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != spaced.encode():
            return None
        return a, np.array(b, np.int64)


class Words:
    """The ids of every word met so far: what lies between two cuts has the same ids wherever it stands."""

    def __init__(self, own: Tokenizers) -> None:
        self._own = own
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids, self._ends = (array("q"), array("q")), (array("q", [0]), array("q", [0]))

    def numbers(self, text: str) -> np.ndarray | None:
        """The numbers of a text's words, good until the next call; none if either kind's bytes are not the text after a space."""
        if sum(map(len, self._ids)) > REMEMBERED:
            self._forget()
        words = CUT.split(text)
        which = [*map(self._known.get, words)]
        if None in which:
            if not self._learn([w for w in dict.fromkeys(words) if w not in self._known]):
                return None
            which = [*map(self._known.__getitem__, words)]
        return np.array(which, np.int64)

    def _learn(self, new: list[str]) -> bool:
        """Encodes new words as one text; those with white space at an end, where a cut would be elsewhere, alone."""
        plain = [w for w in new if w and w.strip() == w]
        for words in [plain, *([w] for w in new if not w or w.strip() != w)]:
            if not words:
                continue
            both = self._own.encode(" ".join(words))
            if both is None:
                return False
            # a word and the space before it
            until = np.cumsum([len(w.encode()) + 1 for w in words])
            for ids, ends, more, lengths in zip(self._ids, self._ends, both, (self._own.a_lengths, self._own.b_lengths), strict=True):
                at = np.searchsorted(np.cumsum(lengths[more]), until, side="right") + len(ids)
                ids.frombytes(more.tobytes())
                ends.frombytes(at.astype(np.int64).tobytes())
            self._known.update(zip(words, range(len(self._known), len(self._known) + len(words)), strict=True))
        return True

    def ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both kinds of the words of these numbers, one after another."""
        a, b = (_rows(ids, ends, which) for ids, ends in zip(self._ids, self._ends, strict=True))
        return a, b


def _rows(flat: array, ends: array, which: np.ndarray) -> np.ndarray:
    """The rows of these numbers, row k lying from ends[k] to ends[k + 1]."""
    end = np.frombuffer(ends, np.int64)
    begin, size = end[which], end[which + 1] - end[which]
    return np.frombuffer(flat, np.int64)[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


def _in_order(byte_level: str) -> bool:
    with open(byte_level, encoding="utf-8") as file:
        model = json.load(file)["model"]
    first = len(model["vocab"]) - len(model["merges"])
    parts = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return all(model["vocab"].get("".join(part)) == first + k for k, part in enumerate(parts))


class Alignment:
    """What is known of a text: numbers of tokens, groups and links; distinct linked pairs and each one's links; its groups or their digest."""

    def __init__(self, own: Tokenizers) -> None:
        self._own = own
        self.numbers = np.zeros(4, np.int64)
        self.keys = self.times = np.zeros(0, np.int64)
        self._digest, self._begun = hashlib.sha256(), False

    def add(self, a: np.ndarray, b: np.ndarray, show: bool) -> str:
        """Takes in a piece: links of its groups, and with `show` its groups as text."""
        end_a, end_b = np.cumsum(self._own.a_lengths[a]), np.cumsum(self._own.b_lengths[b])
        met = np.searchsorted(end_b, end_a)
        last_a, last_b = end_b[met] == end_a, np.zeros(len(b), bool)
        last_b[met[last_a]] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        links = many_a * many_b
        begin_a, begin_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        # groups of usual size link by link; others by their distinct ids
        partners = np.where(links <= GROUP_LINKS, many_b, 0)[group_a]
        before = np.cumsum(partners) - partners
        at = np.arange(int(partners.sum())) + np.repeat(begin_b[group_a] - before, partners)
        keys, times = [np.repeat(a, partners) << 32 | b[at]], [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(links > GROUP_LINKS).tolist():
            own_a, n = np.unique(a[begin_a[g] : begin_a[g] + many_a[g]], return_counts=True)
            own_b, m = np.unique(b[begin_b[g] : begin_b[g] + many_b[g]], return_counts=True)
            keys.append((own_a[:, None] << 32 | own_b).ravel())
            times.append((n[:, None] * m).ravel())
        self.keys, self.times = summed(np.concatenate([self.keys, *keys]), np.concatenate([self.times, *times]))
        self.numbers = self.numbers + np.array([len(a), len(b), len(links), links.sum()])
        if not show:
            return ""
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + begin_b[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + (begin_a + many_a)[group_b]] = 2 * (b + len(self._own.a_lengths)) + last_b
        shown = "".join(map(self._own.shown.__getitem__, order.tolist()))[:-1]
        self._digest.update(f";{shown}".encode() if self._begun else shown.encode())
        self._begun = True
        return shown

    @property
    def digest(self) -> str:
        """SHA-256 of the groups shown so far, in hexadecimal digits."""
        return self._digest.hexdigest()


def pieces_of(text: str) -> Iterator[str]:
    """A long text in pieces of about PIECE characters, cut where no token reaches over; what lies between two cuts stays whole."""
    start = 0
    while len(text) - start > PIECE:
        cut = CUT.search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


@lru_cache(maxsize=2)
def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    """A worker's own tokenizers of two vocabulary files."""
    return Tokenizers(byte_level, pieces)


# Counts over the corpus


def encoded(text: str | None, own: Tokenizers) -> list[tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """Ids of both kinds of each piece of a text, and of its distinct words; an empty list without tokens.

    No group reaches over a cut, so the distinct words have all the links' pairs.
    """
    out = []
    for piece in pieces_of(text) if text else ():
        which = own.words.numbers(piece)
        if which is None:
            return []
        out.append((own.words.ids(which), own.words.ids(np.unique(which))))
    return out


def _counted(byte_level: str, pieces: str, schema: StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Deals a task's documents to chunks; hands on each one's ids, piece by piece, and after a chunk, by bucket, how many of its documents hold each linked pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = tokenizers(byte_level, pieces)
        chunk = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        seen: dict[str | None, tuple[list[tuple], np.ndarray]] = {}
        size = rows = 0
        for batch in batches:
            made: list[tuple] = []
            for place, text in enumerate(batch.column(batch.num_columns - 1)):
                whole = text.as_py()
                if whole not in seen:  # equal texts of a chunk are worked out once
                    ids, aligned = encoded(whole, own), Alignment(own)
                    for _, words in ids:
                        aligned.add(*words, show=False)
                    seen[whole] = [(a.astype(own.id_type).tobytes(), b.astype(own.id_type).tobytes()) for (a, b), _ in ids] or [(None, None)], aligned.keys
                pieces_seen, keys = seen[whole]
                made += [(place, chunk, rows, piece, *both) for piece, both in enumerate(pieces_seen)]
                held.append(keys)
                size += len(text.as_buffer()) if text.is_valid else 0
                rows += 1
                if size >= CHUNK_BYTES or rows >= CHUNK_ROWS:
                    yield _documents(batch, made, schema)
                    yield from _pairs(held, chunk, schema)
                    made, held, seen, size, rows, chunk = [], [], {}, 0, 0, chunk + 1
            yield _documents(batch, made, schema)
        yield from _pairs(held, chunk, schema)

    return run


def _documents(batch: pa.RecordBatch, made: list[tuple], schema: StructType) -> pa.RecordBatch:
    """Rows of ids with their documents' kept columns."""
    place, *columns = zip(*made, strict=True) if made else [()] * 6
    kept = [column.take(pa.array(place, pa.int64())) for column in batch.columns[:-1]]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    none = [pa.nulls(len(made), kind) for kind in (pa.int32(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *none], schema=to_arrow_schema(schema))


def _pairs(held: list[np.ndarray], chunk: int, schema: StructType) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's distinct pairs, one for each bucket."""
    keys = np.concatenate([np.zeros(0, np.int64), *held])
    if not len(keys):
        return
    keys, counts = summed(keys, np.ones(len(keys), np.int64))
    bucket = (keys >> 32) % BUCKETS
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ranges = list(zip(at.tolist(), [*at[1:].tolist(), len(keys)], strict=True))
    shape = to_arrow_schema(schema)
    made = {
        "chunk": pa.array(np.full(len(at), chunk)),
        "bucket": pa.array(bucket[at].astype(np.int32)),
        "keys": pa.array([keys[a:b].tobytes() for a, b in ranges], pa.binary()),
        "counts": pa.array([counts[a:b].tobytes() for a, b in ranges], pa.binary()),
    }
    yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(len(at), f.type) for f in shape], schema=shape)


def _numbers(column: pa.ChunkedArray, dtype: type = np.int64) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), dtype) for value in column]


def _row(schema: str, *values: object) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table([pa.array([v], kinds[kind]) for v, (_, kind) in zip(values, fields, strict=True)], names=[name for name, _ in fields])


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    """The partial counts of a node as one."""
    keys, counts = summed(np.concatenate(_numbers(table.column("keys"))), np.concatenate(_numbers(table.column("counts"))))
    return _row(PARTIAL, key[0].as_py(), key[1].as_py(), keys.tobytes(), counts.tobytes())


def _dictionary(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket's pairs in the order of their slots, their counts, and which are their first id's highest."""
    parts = list(zip(_numbers(table.column("keys")), _numbers(table.column("counts")), strict=True))
    distinct = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))[0]
    hashed = PerfectHash.of(distinct)
    vectors = []
    for keys, counts in parts:
        vector = np.zeros(len(distinct), np.int64)
        vector[hashed.slots(keys)] = counts
        vectors.append(vector)
    while len(vectors) > 1:
        vectors = [vectors[k] + vectors[k + 1] if k + 1 < len(vectors) else vectors[k] for k in range(0, len(vectors), 2)]
    slots = hashed.slots(distinct)
    in_order, counts = np.empty_like(distinct), vectors[0]
    in_order[slots] = distinct
    # distinct keys are in order, so those of one first id lie together
    ids, own = distinct >> 32, counts[slots]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    most = np.repeat(np.maximum.reduceat(own, first), np.diff([*first.tolist(), len(ids)]))
    best = np.zeros(len(distinct), np.uint8)
    best[slots] = own == most
    return _row(DICTIONARY, key[0].as_py(), hashed.sizes_bytes, hashed.taken_bytes, in_order.tobytes(), counts.tobytes(), best.tobytes())


def _looked_up(key: tuple, wanted: pa.Table, dictionary: pa.Table) -> pa.Table:
    """For each chunk's pairs of a bucket their counts, by slot; a pair whose slot holds another key is an error."""
    hashed = PerfectHash.read(dictionary.column("sizes")[0].as_py(), dictionary.column("taken")[0].as_py())
    known, counts = (_numbers(dictionary.column(name))[0] for name in ("keys", "counts"))
    best = _numbers(dictionary.column("best"), np.uint8)[0]
    out: dict[str, list] = {"counts": [], "best": []}
    for keys in _numbers(wanted.column("keys")):
        slots = hashed.slots(keys)
        if (slots < 0).any() or (known[slots] != keys).any():
            raise ValueError("a pair of the second pass was not counted in the first")
        out["counts"].append(counts[slots].tobytes())
        out["best"].append(best[slots].tobytes())
    return pa.table([wanted.column("chunk"), wanted.column("keys"), *(pa.array(v, pa.binary()) for v in out.values())], names=["chunk", "keys", *out])


def _scored(byte_level: str, pieces: str, schema: StructType, groups: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A chunk's documents, aligned again, with the counts of their links."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        own = tokenizers(byte_level, pieces)
        keys = np.concatenate([np.zeros(0, np.int64), *_numbers(found.column("keys"))])
        order = np.argsort(keys)
        keys = keys[order]
        counts = np.concatenate([np.zeros(0, np.int64), *_numbers(found.column("counts"))])[order]
        best = np.concatenate([np.zeros(0, np.uint8), *_numbers(found.column("best"), np.uint8)])[order]
        docs = docs.sort_by([("row", "ascending"), ("piece", "ascending")]).combine_chunks()
        ids = [docs.column(name).combine_chunks() for name in ("a_ids", "b_ids")]
        number = docs.column("row").to_numpy()
        firsts = np.flatnonzero(np.concatenate((number[:1] == number[:1], number[1:] != number[:-1])))
        rows = []
        seen: dict[tuple[bytes | None, bytes | None], tuple] = {}
        for first, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(number)], strict=True):
            one = (ids[0][first].as_py(), ids[1][first].as_py()) if end == first + 1 else None
            if one in seen:
                rows.append(seen[one])
                continue
            aligned, shown = Alignment(own), []
            for k in range(first, end) if ids[0][first].is_valid else ():
                shown.append(aligned.add(*(np.frombuffer(each[k].as_buffer(), own.id_type).astype(np.int64) for each in ids), show=True))
            at = np.searchsorted(keys, aligned.keys)
            highest, total = int(aligned.times[best[at] == 1].sum()), int((aligned.times * counts[at]).sum())
            rows.append((*aligned.numbers.tolist(), highest, total, aligned.digest if shown else "", *([";".join(shown)] if groups else [])))
            if one is not None:
                seen[one] = rows[-1]
        shape = to_arrow_schema(schema)
        kept = [docs.column(k).take(pa.array(firsts)) for k in range(docs.num_columns - 5)]
        made = [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), list(shape)[len(kept) :], strict=True)]
        return pa.Table.from_arrays([*kept, *made], schema=shape)

    return run


def align_documents(docs: DataFrame, byte_level: str, pieces: str, text: str = "text", keep: list[str] | None = None, groups: bool = False) -> DataFrame:
    """The `keep` columns (doc_id) of each row; numbers of tokens, groups and links; and how common its links are.

    The groups' digest is of their text, ids of both kinds in order as
    `a1,a2|b1;a3|b2,b3`; with `groups` that text is there too.

    n_best counts links whose pair is the most frequent of its first id in the
    whole table, ties included; count_sum adds up the pairs' document counts
    over links. `byte_level` is a byte-level vocabulary's file, `pieces` one of
    pieces with byte fallback. Null and empty texts, and those whose tokens do
    not give their bytes back, have zeros. Each repeated row counts.

    Documents are encoded once and written as ids, in chunks, beside each
    chunk's distinct pairs. Only those pairs, not links, are counted: put
    together in a tree of FAN_IN for each bucket, hashed and summed there, and
    looked up by chunk, where the documents are aligned again. A bucket is
    bounded by the vocabularies, a chunk by CHUNK_BYTES or one text.
    """
    keep = ["doc_id"] if keep is None else keep
    schema = with_fields(docs, keep, COUNTS + (", groups string" if groups else ""))
    if len({name.lower() for name in schema.names}) < len(schema.names):
        raise ValueError(f"a kept column is named as an answer: {', '.join(keep)}")
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"kept_{k}") for k, c in enumerate(keep)], F.col(text).cast("string").alias("text"))
    kept = numbered.columns[:-1]
    held = with_fields(numbered, kept, CHUNKED)
    chunked = written(numbered.mapInArrow(_counted(byte_level, pieces, held), held), "chunks-aligned")

    texts = chunked.where("bucket IS NULL").select(*kept, "chunk", "row", "piece", "a_ids", "b_ids")
    pairs = chunked.where("bucket IS NOT NULL").select("bucket", "chunk", "keys", "counts")
    chunks = texts.agg(F.count_distinct("chunk")).first()[0]
    partial, nodes = pairs.select("bucket", F.xxhash64("chunk").alias("node"), "keys", "counts"), chunks
    while nodes > FAN_IN:
        nodes = -(-nodes // FAN_IN)
        dealt = partial.withColumn("node", F.pmod("node", F.lit(nodes)))
        partial = dealt.groupBy("bucket", "node").applyInArrow(_merged, PARTIAL)
    dictionary = written(partial.groupBy("bucket").applyInArrow(_dictionary, DICTIONARY), "pair-counts")

    shards = max(1, -(-chunks // SHARD_CHUNKS))
    wanted = pairs.select("bucket", "chunk", "keys", F.pmod(F.xxhash64("chunk"), F.lit(shards).cast("bigint")).alias("shard"))
    copies = dictionary.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))
    found = wanted.groupBy("bucket", "shard").cogroup(copies.groupBy("bucket", "shard")).applyInArrow(_joined, FOUND)
    return texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_scored(byte_level, pieces, schema, groups), schema)


def _joined(key: tuple, wanted: pa.Table, dictionary: pa.Table) -> pa.Table:
    """Look-ups of a bucket's shard; a copy of the dictionary that no chunk of the shard needs gives nothing."""
    if not wanted.num_rows:
        return pa.table([pa.array([], kind) for kind in (pa.int64(), pa.binary(), pa.binary(), pa.binary())], names=["chunk", "keys", "counts", "best"])
    return _looked_up(key, wanted, dictionary)
