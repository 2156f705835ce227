"""Sharding, top-k search, decontamination, the pipeline and the registered queries."""

import hashlib
import importlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acceptance.check import oracle_rows, spark_rows
from eventlake.llm import decontaminate, passages, topk
from eventlake.llm.queries import ORACLES, QUERIES
from eventlake.llm.sharding import rendezvous_shard, shard_documents, slots
from eventlake.llm.tables import bit_filter, in_filter
from eventlake.llm.topk import branch_and_bound, nearest
from eventlake.llm.words import MARKS, SPACELESS, letter_tokens

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, "/root/testdata/sf0.01")) == oracle_rows("/root/testdata/sf0.01", ORACLES[name])


def unit(*parts):
    return (int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def test_weights_and_moves(spark):
    weights = {0: 1.0, 1: 2.0, 2: 1.0}
    keys = spark.range(6000)
    got = {r.id: r for r in keys.select("id", rendezvous_shard(F.col("id"), weights).alias("a"), rendezvous_shard(F.col("id"), {**weights, 3: 1.0}).alias("b")).collect()}
    for k, r in got.items():
        assert r.a == max(weights, key=lambda s: -weights[s] / math.log(unit(str(k), str(s))))
        assert r.b in (r.a, 3)
    counts = Counter(r.a for r in got.values())
    assert abs(counts[1] / 6000 - 0.5) < 0.03 and abs(counts[0] / 6000 - 0.25) < 0.03
    with pytest.raises(ValueError):
        rendezvous_shard(F.col("id"), {0: 0.0})


def test_shards_of_edge_rows(corpus, nothing):
    texts = corpus.select("doc_id", "text").collect()
    got = shard_documents(corpus, 24)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    by_shard = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) and r.law == "key"
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert shard_documents(nothing, 24).count() == 0


def test_slots_of_many_copies(spark):
    rows = spark.range(5000).select(F.lit(1).alias("shard"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    got = [r.slot for r in slots(rows, "shard", ["k"], piece_rows=100).collect()]
    assert sorted(got) == list(range(5000))


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.normal(size=40)]) for i in range(300)]
    vectors += [(300, vectors[5][1]), (301, vectors[5][1]), (302, None), (303, [float("nan")] * 40), (304, [float("inf")] + [0.0] * 39), (305, [None] + [0.0] * 39), (None, vectors[0][1]), (306, [1.0]), (350, [2.0]), (400, []), (450, []), (7, vectors[7][1]), (100, vectors[100][1]), (100, vectors[9][1])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("query", F.lit("x"))
    sound = []
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    expected = Counter()
    for own, (q, x) in enumerate(sound):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for n, (c, y) in enumerate(sound) if n != own and len(y) == len(x))
            expected += Counter((q, rank, c, -s) for rank, (s, c) in enumerate(scores[:5], 1))
    got = nearest(table, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert nearest(table.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest(table.where("vec_id = 0").limit(1), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_takes_rows_with_one_id_and_counts_exactly(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 58880), (0, 2, 1, 32768)]
    high = [(0, [1e6, 1.0]), (1, [1e6, 3.0]), (2, [-1e6, 5.0])]
    got = nearest(spark.createDataFrame(high, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 256000000**2 + 256 * 768), (0, 2, 2, -(256000000**2) + 256 * 1280)]
    beyond = [(0, [1e9, 1e9]), (1, [1e9, 1e9]), (2, [-1e9, 0.0])]
    with pytest.raises(Exception, match="63 bits"):
        nearest(spark.createDataFrame(beyond, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()


def test_top_k_over_many_blocks_sends_no_block_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(2)
    x = rng.integers(-256, 256, (700, 40))
    x[rng.integers(0, 700, 60)] = x[3]
    table = spark.createDataFrame([(i, [v / 256 for v in row]) for i, row in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = nearest(table, F.col("vec_id") % 50 == 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
    expected = set()
    for q in range(0, 700, 50):
        scores = x @ x[q]
        best = [c for c in np.lexsort((np.arange(700), -scores)) if c != q][:5]
        expected |= {(q, rank, c, scores[c]) for rank, c in enumerate(best, 1)}
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    # a task hands on k rows a query, whatever the number of blocks that it has seen
    made = topk._search(5)
    def pair(block):
        rows = np.arange(block * 50, block * 50 + 50)
        values = {"dims": [40], "rows": [rows], "ids": [rows], "columns": [np.ascontiguousarray(x[rows].T).tobytes()]}
        return pa.record_batch({**values, "query_block": [0], "query_rows": [[0, 50]], "query_ids": [[0, 50]], "query_columns": [np.ascontiguousarray(x[[0, 50]].T).tobytes()]})
    out = pa.Table.from_batches(made(pair(block) for block in range(14))).to_pylist()
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in out) == sorted((q, c, s) for q, _, c, s in expected if q in (0, 50))


def test_bounds_drop_candidates_and_nothing_else():
    rng = np.random.default_rng(1)
    columns = rng.integers(-256, 256, (64, 2000))
    columns[:, :20] *= 6
    queries = rng.integers(-256, 256, (5, 64))
    for (at, score), q in zip(branch_and_bound(queries, columns, 5), queries, strict=True):
        exact = q @ columns
        order = np.lexsort((np.arange(2000), -exact))[:5]
        assert list(at) == list(order) and list(score) == list(exact[order])


def test_masks_miss_nothing():
    for size in range(decontaminate.LEAST, decontaminate.WINDOW + 1):
        for spoilt in combinations(range(size), decontaminate.allowed(size)):
            assert any(not any(o + p in spoilt for p in mask) for mask in decontaminate.MASKS for o in range(size - mask[-1]))


def tokens(text):
    alone, marks = ("".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) for ranges in (SPACELESS, MARKS))
    return re.findall(f"[{alone}]|(?:(?![{alone}{marks}])[0-9a-z\x80-\U0010ffff])+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def test_tokens_of_all_scripts():
    rng = random.Random(6)
    marks = ["a", "Bc", "é", "日", "本", "ไทย", "한국", "ж", "“", "”", "\u00a0", "、", "。", "!", "ｗ", "1", "º", "𠀀", "🙂", " ", ".", "\u2019", "ខ្មែរ", "မြန်", "カ", "\u3000"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(12))) for _ in range(400)] + ["", "日", "é日", "日é"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    hashes, counts, starts, ends = letter_tokens(data, offsets, (), 1, scripts=True)
    found = [re.sub("[A-Z]+", lambda m: m.group().lower(), bytes(data[a:b]).decode()) for a, b in zip(starts, ends, strict=True)]
    assert found == [w for t in texts for w in tokens(t)] and counts.tolist() == [len(tokens(t)) for t in texts]
    assert len({(w, int(h)) for w, h in zip(found, hashes[:, 0], strict=True)}) == len(set(found))


def test_leaks_without_spaces(spark):
    item = "人人生而自由在尊严和权利上一律平等他们赋有理性和良心"
    thai = "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกัน"
    changed = item[:5] + "吗" + item[6:]
    docs = list(enumerate([f"前言后语。{item}。结束", f"“{changed}”", "人人都在学习中文和数学", thai, f"x {thai[:20]} y", item[:13], item[:9] + "\n", "“Quoted”\u00a0words, that’s all", None, ""]))
    items = [(1, item), (2, f"{thai}"), (3, "quoted words that s all of one short item here")]
    expected = plain_leaks(docs, items)
    assert {(0, 1), (1, 1), (3, 2), (4, 2), (5, 1)} == expected
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaked_documents(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected
    (first,) = [r for r in got if r.doc_id == 0]
    assert docs[0][1][first.start : first.end] == item


def plain_leaks(docs, items):
    found = set()
    for d, text in docs:
        w = tokens(text)
        for i, item in items:
            v = tokens(item)
            size = min(13, len(v))
            if len(v) < 8:
                continue
            for shift in range(-len(v) + size, len(w) - size + 1):
                a, b = max(0, shift), min(len(w), len(v) + shift)
                equal = [w[x] == v[x - shift] for x in range(a, b)]
                if any(sum(equal[x : x + size]) >= size - size // 6 for x in range(len(equal) - size + 1)):
                    found.add((d, i))
                    break
    return found


def test_leaks_against_brute_force(spark):
    item = [f"Item{i}" for i in range(30)]
    short = [f"s{i}" for i in range(9)]
    filler = [f"f{i}" for i in range(40)]
    near = item[:]
    near[6], near[12] = "other", "else"
    far = item[:]
    far[::4] = ["x"] * 8
    texts = [
        " ".join(filler + item + filler), " ".join(filler + near[:13]), " ".join(far), " ".join(item[17:]).upper(), " ".join(item[18:]), ", ".join(short), " ".join(short[:8]),
        " ".join(filler), None, "", " ".join(short[:4] + ["q"] + short[5:]), " ".join(item[5:20]) + "\n" + " ".join(item[5:20]), "é " * 30_000 + " ".join(item),
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[0])]
    items = [(1, " ".join(item)), (2, " ".join(short)), (3, "too short"), (4, None), (5, ""), (None, " ".join(item)), (1, " ".join(item))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("seed", F.lit(1)).withColumn("item_key", F.lit("k"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("seed", F.lit("z"))
    got = decontaminate.leaked_documents(frame, bench).collect()
    expected = plain_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == expected and expected
    for r in got:
        if r.doc_id is not None:
            span = tokens(dict(docs)[r.doc_id][r.start : r.end])
            assert len(span) == r.tokens and r.equal <= r.tokens
    left = decontaminate.without_leaks(frame, bench)
    assert left.schema == frame.schema
    bad = {d for d, _ in expected}
    assert sorted(map(repr, [r.doc_id for r in left.collect()])) == sorted(repr(d) for d, _ in docs if d not in bad)
    assert decontaminate.leaked_documents(frame, bench.where("false")).count() == 0
    assert decontaminate.leaked_documents(frame.where("false"), bench).count() == 0


def test_a_phrase_of_all_items(spark):
    """Texts with it are told by one item; those that only another item tells are still found."""
    phrase = [f"p{i}" for i in range(11)]
    items = [(i, " ".join([f"a{i}x{k}" for k in range(6)] + phrase + [f"b{i}x{k}" for k in range(6)])) for i in range(40)]
    docs = [(d, " ".join([f"c{d}x{k}" for k in range(9)] + phrase + [f"d{d}x{k}" for k in range(9)])) for d in range(60)]
    # too little of the phrase, but more of one item
    docs += [(100 + i, " ".join([f"q{i}"] * 5 + items[i][1].split()[: 6 + i % 9] + [f"r{i}"] * 5)) for i in range(40)]
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    expected = {d for d, _ in plain_leaks(docs, items)}
    assert len(expected) > 60 and len(expected) < 100
    left = decontaminate.without_leaks(frame.withColumn("__key", F.lit(1)), bench)
    assert left.columns == ["doc_id", "text", "__key"]
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - expected
    assert {r.doc_id for r in decontaminate.leaked_documents(frame, bench).collect()} == expected


def test_filter_has_no_false_negatives(spark):
    values = spark.range(3000).select(F.xxhash64("id").alias("v"))
    seen = bit_filter(values)
    own = np.array([r.v for r in values.collect()], np.int64)
    assert in_filter(seen, own).all()
    assert in_filter(seen, np.arange(100_000, dtype=np.int64)).mean() < 0.2
    assert not in_filter(bit_filter(values.where("false")), own).any()


@pytest.mark.parametrize("most_bits", [27, 19, 18, 17])
def test_filter_lets_few_others_through(spark, most_bits):
    """One in 400 for whatever number of values, until it may not grow; then more, but never all, and none is lost."""
    values = spark.range(65_000).select(F.xxhash64("id").alias("v"))
    seen = bit_filter(values, 15, most_bits)
    assert seen.nbytes <= 1 << (most_bits - 3)
    assert in_filter(seen, np.array([r.v for r in values.collect()], np.int64)).all()
    others = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 400_000)
    assert in_filter(seen, others).mean() < {27: 0.003, 19: 0.03, 18: 0.17, 17: 0.41}[most_bits]


def test_runs_do_not_pass_by_chance(spark):
    """Few of the runs whose prints occur once are handed on, though many other prints are shared."""
    shared = bit_filter(spark.range(65_000).select(F.xxhash64("id").alias("print")))
    hot = bit_filter(spark.range(0))
    texts = [" ".join(f"w{t}x{k}" for k in range(300)) for t in range(400)]
    batch = pa.record_batch([pa.array(range(400), pa.int64()), pa.array(texts)], names=["own", "__text"])
    passed = sum(b.num_rows for b in passages._runs(shared, hot)(iter([batch])))
    assert passed < 0.01 * 400 * (300 - passages.PASSAGE + 1)


def test_every_query_has_whole_results(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    for name in ("op1_paragraph_dedup", "op2_ppm_language_id", "op3_crf_toxicity", "op4_rendezvous_sharding", "op6_minhash_near_dedup", "op9_byte_bpe", "op10_weak_label_quality"):
        rows = QUERIES[name](spark, SMALL).select("doc_id").collect()
        assert len(rows) == n == len({r.doc_id for r in rows}), name
    ids = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    vectors = {r.vec_id for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id").collect()}
    nearest_rows = QUERIES["op8_branch_and_bound_top_k"](spark, SMALL).collect()
    assert {r.query_id for r in nearest_rows} == {v for v in vectors if v % 50 == 0} and {r.vec_id for r in nearest_rows} <= vectors


def test_leak_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op5_spaced_seed_decontamination"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain_leaks(docs, items) and len(got) > 0


def test_entry_has_them():
    entry = importlib.import_module("__spark_entry__")
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert "corpus_pipeline" in sys.modules
