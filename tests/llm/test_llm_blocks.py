"""Blocks of a batch compared at once, shingles made for wanted units only, and what a task's Python process gives back."""

import numpy as np
import pyarrow as pa

from eventlake.llm import minhash, passages, tables
from eventlake.llm.minhash import TEXTS, _agreeing, _forests_of_blocks, _Parts
from eventlake.llm.paragraphs import LINES
from eventlake.llm.words import distinct_counts, distinct_sorted
from llm.conftest import words

MEMBER = pa.struct([("key", pa.binary()), ("root", pa.binary()), ("n", pa.int64()), ("sig", pa.binary())])


def blocks_of(sizes, seed):
    """Blocks with members of three kinds of signature, some of one root, and the first one listed twice."""
    rng = np.random.default_rng(seed)
    kinds = rng.integers(0, 256, (3, 36)).astype(np.uint8)
    blocks = []
    for size in sizes:
        block = []
        for _ in range(size):
            sig = kinds[rng.integers(3)].copy()
            sig[rng.random(36) < 0.15] += 1
            key = rng.bytes(16)
            block.append({"key": key, "root": block[0]["root"] if block and rng.random() < 0.2 else key, "n": int(rng.integers(30, 42)), "sig": sig.tobytes()})
        blocks.append([*block, dict(block[0])])
    return blocks


def plain_forest(blocks, least, percent):
    out = []
    for block in blocks:
        members = list({m["key"]: m for m in block}.values())
        parts = _Parts([m["root"] for m in members])
        for a, b in _agreeing(members, parts, least, percent):
            if parts.top(a) != parts.top(b):
                parts.join(a, b)
                out.append(tuple(sorted((members[a]["key"], members[b]["key"]))))
    return sorted(out)


def test_many_small_blocks_are_compared_at_once():
    blocks = blocks_of([1, 2, 3, 2, 2, 40, 2, 5] * 20, 3)
    batch = pa.record_batch([pa.array(blocks, pa.list_(MEMBER))], names=["members"]).slice(2)
    for percent in (75, 90):
        got = list(_forests_of_blocks(0.6, percent)(iter([batch])))
        pairs = sorted(p for b in got for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True))
        assert pairs == plain_forest(blocks[2:], 0.6, percent) and len(pairs) > 100 and len(got) == 1
    alone = pa.record_batch([pa.array(blocks_of([1, 1], 4), pa.list_(MEMBER))], names=["members"])
    assert list(_forests_of_blocks(0.6, 75)(iter([alone, alone.slice(2)]))) == []


def test_distinct_values_of_rows_are_counted_by_whole_values():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 40, 300)
    values = rng.integers(0, 60, counts.sum(), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ends = np.cumsum(counts)
    assert distinct_counts(values, counts).tolist() == [len(distinct_sorted(values[e - c : e])) for e, c in zip(ends, counts, strict=True)]
    # these differ in their lowest bits alone
    assert distinct_counts(np.array([8, 9, 8, 8], np.uint64), np.array([2, 0, 2])).tolist() == [2, 0, 1]
    assert distinct_counts(np.zeros(0, np.uint64), np.zeros(3, np.int64)).tolist() == [0, 0, 0]


def test_shingles_are_made_for_wanted_lines_only(monkeypatch):
    texts = ["\n".join(" ".join(words(10 * t + k, 12)) for k in range(10)) for t in range(30)]
    named = pa.record_batch([pa.array(texts)], names=["__text"])
    units = pa.Table.from_batches(list(minhash._signatures(LINES)(iter([named]))))
    wanted = units.column("key")[7].as_py()
    half = np.frombuffer(wanted[:8], np.uint64)
    seen = np.zeros(1 << 17, np.uint8)
    place = int(tables.xxhash64_of_longs(half)[0] >> np.uint64(64 - 20))
    seen[place >> 3] = 1 << (place & 7)
    made, before = [], minhash.shingle_hashes
    monkeypatch.setattr(minhash, "shingle_hashes", lambda words, counts: made.append(len(counts)) or before(words, counts))
    got = [r for b in minhash._sets(LINES, seen)(iter([named])) for r in b.to_pylist()]
    assert wanted in [r["key"] for r in got] and sum(made) == len(got) < 5
    nothing = list(minhash._sets(LINES, np.zeros(1 << 17, np.uint8))(iter([named])))
    assert nothing == []


def test_what_arrow_keeps_is_given_back(monkeypatch):
    named = pa.record_batch([pa.array([" ".join(words(1, 60))] * 2)], names=["__text"])
    given = []
    monkeypatch.setattr(minhash, "release", lambda: given.append(1), raising=False)
    monkeypatch.setattr(passages, "release", lambda: given.append(1), raising=False)
    list(minhash._signatures(TEXTS)(iter([named])))
    list(passages._prints(iter([named])))
    assert given == [1, 1]
