"""Tokenizer alignment against a plain version on whole texts, perfect hashing, and edge rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventlake.llm import alignment
from eventlake.llm.alignment import align_documents
from eventlake.llm.perfect_hash import PerfectHash
from eventlake.llm.queries import BYTE_LEVEL, PIECES, op11_tokenizer_alignment

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    """(numbers, groups, links by pair) of a text, straight from the two libraries and their own vocabularies."""
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    printable = [c for c in range(256) if chr(c).isprintable() and c not in (32, 173) and (c < 127 or c > 160)]
    others = [c for c in range(256) if c not in printable]
    byte_of = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(others)}

    def align(text):
        if not text:
            return None
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return None
        ends_a, ends_b = ([sum(map(len, raw[: k + 1])) for k in range(len(raw))] if len(raw) < 50 else np.cumsum([len(r) for r in raw]).tolist() for raw in (raw_a, raw_b))
        both = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for end in both:
            own_a, own_b = [], []
            while i < len(ends_a) and ends_a[i] <= end:
                own_a.append(ids_a[i])
                i += 1
            while j < len(ends_b) and ends_b[j] <= end:
                own_b.append(ids_b[j])
                j += 1
            groups.append((own_a, own_b))
        links = Counter((x, y) for own_a, own_b in groups for x in own_a for y in own_b)
        return (len(ids_a), len(ids_b), len(groups), links.total()), ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups), links

    return align


def expected(plain, texts):
    """One tuple of answers for each text, with counts over all of them."""
    aligned = [plain(t) for t in texts]
    count = Counter(pair for each in aligned if each for pair in each[2])
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for each in aligned:
        if each is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        numbers, groups, links = each
        best = sum(n for p, n in links.items() if count[p] == most[p[0]])
        out.append((*numbers, best, sum(n * count[p] for p, n in links.items()), hashlib.sha256(groups.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(4)
    marks = ["a", "B", "é", "ß", " ", " ", "  ", "\n", "\t", " ", "　", "日本", "語", "한국", "ж", "🙂", "'s", "'ll", "<s>", "<|endoftext|>", "<0x41>", "▁", "1", "½", "_", "é", "\x00", "\x1c", "​", "word", "Zusammenarbeit", ".", "--"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 60))) for _ in range(250)]
    texts += ["", None, " ", "a", " a", "a ", "▁", "<unk>", "\n\n  x", "a" * 9000, " " * 5000 + "x", "ab " * 4000, "日本語" * 2000]
    return texts + [texts[0]] * 40 + [None, ""]


def rows_of(frame):
    return sorted((r.doc_id, *r[1:8]) for r in frame.collect())


@pytest.mark.parametrize("piece, remembered", [(1 << 20, alignment.REMEMBERED), (40, alignment.REMEMBERED), (40, 100)])
def test_odd_texts(spark, plain, odd_texts, monkeypatch, piece, remembered):
    texts = odd_texts
    wanted = sorted((k, *row) for k, row in enumerate(expected(plain, texts)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    # pieces are cut and links listed in the workers, which take these from the driver's closure only
    own = alignment.tokenizers(BYTE_LEVEL, PIECES)
    monkeypatch.setattr(alignment, "PIECE", piece)
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    monkeypatch.setattr(alignment, "GROUP_LINKS", 4096 if piece > 40 else 2)
    for text in texts:
        found, each = alignment.encoded(text, own), plain(text)
        assert bool(found) == (each is not None)
        if found:
            whole = alignment.Alignment(own)
            shown = [whole.add(*ids, show=True) for ids, _ in found]
            assert (tuple(whole.numbers.tolist()), ";".join(shown)) == each[:2]
            assert dict(zip([(k >> 32, k & 0xFFFFFFFF) for k in whole.keys.tolist()], whole.times.tolist(), strict=True)) == dict(each[2])
            words = alignment.Alignment(own)
            for _, ids in found:
                words.add(*ids, show=False)
            assert words.keys.tolist() == whole.keys.tolist()
            assert whole.digest == hashlib.sha256(each[1].encode()).hexdigest()
    if piece > 40:
        assert rows_of(align_documents(docs, BYTE_LEVEL, PIECES)) == wanted


def test_query_against_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted((d.doc_id, *row) for d, row in zip(docs, expected(plain, [d.text for d in docs]), strict=True))
    assert rows_of(op11_tokenizer_alignment(spark, SMALL)) == wanted


def test_trees_and_shards(spark, plain, monkeypatch):
    """Many chunks: a tree of three levels and several shards give the same counts."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "Überraschung", "naïve", "x1"]) for _ in range(rng.randrange(9))) for _ in range(200)]
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    monkeypatch.setattr(alignment, "SHARD_CHUNKS", 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(20)
    assert rows_of(align_documents(docs, BYTE_LEVEL, PIECES)) == sorted((k, *row) for k, row in enumerate(expected(plain, texts)))


def test_edge_rows(corpus, nothing, plain):
    kept = ["doc_id", "key", "bucket", "root", "text"]
    got = align_documents(corpus.withColumnRenamed("score", "chunk"), BYTE_LEVEL, PIECES, keep=[*kept, "chunk"], groups=True)
    assert got.columns == [*kept, "chunk", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    rows = got.collect()
    assert len(rows) == corpus.count()
    for r in rows:
        each = plain(r.text)
        assert (r.groups, r.n_links) == ((each[1], each[0][3]) if each else ("", 0)) and (r.bucket, r.root, r.chunk) == (1, "r", 0.5)
    assert align_documents(nothing, BYTE_LEVEL, PIECES).count() == 0
    with pytest.raises(ValueError):
        align_documents(corpus.withColumnRenamed("root", "N_A"), BYTE_LEVEL, PIECES, keep=["N_A"])


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000, 200_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(1 << 62, n, replace=False).astype(np.int64) if n else np.zeros(0, np.int64)
    made = PerfectHash.of(keys)
    read = PerfectHash.read(made.sizes_bytes, made.taken_bytes)
    assert np.array_equal(np.sort(read.slots(keys)), np.arange(n))
    assert len(made.taken) <= 200 + 4 * n
    others = keys ^ (1 << 62)
    assert ((read.slots(others) >= -1) & (read.slots(others) < max(n, 1))).all()


def test_repeated_keys_have_no_perfect_hash():
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([5, 5], np.int64))
