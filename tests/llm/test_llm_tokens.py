"""Byte-level BPE and packing against the tokenizer's library and round trips."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import bpe
from eventlake.llm.packing import Capacities, best_fit_decreasing, pack_documents, pack_tokens, position_ids, resets, write_packed
from eventlake.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe._ranks(RANKS), special_tokens={})


HARD = ["a" * 5000 + " b", "  \n\n  x " * 400, "ab " * 3000, "日本語テキスト、" * 900, "don't we'll  'they   x\x1c\x1d y" * 300, "<|endoftext|> " * 200, "9 99 999 " * 500, " " * 4000]


@pytest.mark.parametrize("chunk, overlap", [(300, 40), (1000, 200), (bpe.CHUNK, bpe.OVERLAP)])
def test_ids_are_the_librarys(spark, corpus, library, chunk, overlap):
    texts = corpus.select("doc_id", "text").unionAll(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string"))
    got = bpe.encode_documents(texts, RANKS, PATTERN, chunk=chunk, overlap=overlap)
    expected = sorted((repr(r.doc_id), library.encode_ordinary(r.text or "")) for r in texts.collect())
    assert sorted((repr(r.doc_id), list(r.token_ids)) for r in got.collect()) == expected


def test_digests_and_round_trip(corpus, library):
    texts = {r.doc_id: r.text or "" for r in corpus.where("doc_id is not null").collect()}
    for r in bpe.token_digests(corpus, RANKS, PATTERN).where("doc_id is not null").collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_nothing_and_nulls(spark, nothing):
    assert bpe.token_digests(nothing, RANKS, PATTERN).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.bytes for r in bpe.decode_documents(rows, RANKS).collect()} == {1: None, 2: bytearray()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_decreasing(sizes):
    bins = best_fit_decreasing(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    # a plain version: the fullest bin that has room; as many bins
    free = []
    for size in sorted(sizes, reverse=True):
        room = [f for f in free if f >= size]
        if room:
            free[free.index(min(room))] -= size
        else:
            free.append(50 - size)
    assert sorted(free) == sorted(50 - sum(sizes[i] for i in b) for b in bins)


def test_capacity_search():
    tree = Capacities(10)
    for free, number in ((3, 0), (7, 1), (7, 2), (10, 3)):
        tree.add(free, number)
    assert tree.take(4)[0] == 7 and tree.take(4)[0] == 7 and tree.take(4) == (10, 3) and tree.take(4) is None and tree.take(3) == (3, 0)


@pytest.mark.parametrize("at_once", [False, True])
def test_packing_loses_nothing(spark, corpus, path, at_once):
    docs = corpus.where("doc_id is not null").dropDuplicates(["doc_id"])
    tokens = bpe.encode_documents(docs, RANKS, PATTERN)
    packed = pack_documents(docs, RANKS, PATTERN, 128, 5000) if at_once else pack_tokens(tokens, length=128, group_tokens=5000)
    write_packed(packed, path("packed"))
    found, seen = {}, set()
    back = spark.read.parquet(path("packed"))
    assert back.columns == ["pack_id", "n_tokens", "doc_ids", "parts", "cu_seqlens", "ids", "resets"]
    for r in back.select("*", position_ids(back.cu_seqlens).alias("positions")).collect():
        ids = [int.from_bytes(r.ids[i : i + 4], "little", signed=True) for i in range(0, len(r.ids), 4)]
        assert len(ids) == 128 and r.n_tokens == r.cu_seqlens[-1] and ids[r.n_tokens :] == [-1] * (128 - r.n_tokens)
        assert r.resets == r.cu_seqlens[:-1] and [i for i, p in enumerate(r.positions) if p == 0] == r.resets
        assert r.pack_id not in seen
        seen.add(r.pack_id)
        for doc, part, a, b in zip(r.doc_ids, r.parts, r.resets, r.cu_seqlens[1:], strict=True):
            assert (doc, part) not in found
            found[doc, part] = ids[a:b]
    for r in tokens.collect():
        whole = [x for part in range(-(-len(r.token_ids) // 128)) for x in found.pop((r.doc_id, part))]
        assert whole == list(r.token_ids)
    assert not found


def test_the_packing_query_rebuilds_every_document(spark):
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe._ranks(RANKS), special_tokens={})
    rows = QUERIES["op7_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    found = {}
    for r in rows:
        assert r.n_tokens <= 2048 == len(r.ids) // 4 and r.resets == r.cu_seqlens[:-1]
        ids = [int.from_bytes(r.ids[i : i + 4], "little", signed=True) for i in range(0, len(r.ids), 4)]
        for doc, part, a, b in zip(r.doc_ids, r.parts, r.resets, r.cu_seqlens[1:], strict=True):
            assert (doc, part) not in found
            found[doc, part] = ids[a:b]
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        assert [x for part in range(-(-len(ids) // 2048)) for x in found.pop((r.doc_id, part))] == ids
    assert not found


def test_packing_nulls_and_nothing(spark, nothing):
    assert pack_documents(nothing, RANKS, PATTERN).count() == 0
    rows = spark.createDataFrame([(None, [1, 2]), (1, None), (1, [3]), (1, [3]), (2, [])], "doc_id long, token_ids array<int>").coalesce(1)
    (row,) = pack_tokens(rows, length=8).collect()
    assert row.n_tokens == 4 and sorted(map(repr, row.doc_ids)) == ["1", "1", "None"]
    assert pack_tokens(rows.where("false")).count() == 0
    assert rows.select(resets(rows.token_ids)).count() == 5
