"""Near-duplicates, components and paragraph dedup against plain versions."""

import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import off_the_benchmark
from eventlake.llm import passages
from eventlake.llm.components import components
from eventlake.llm.minhash import TEXTS, _agreeing, _Parts, similar_documents, without_near_duplicates
from eventlake.llm.paragraphs import LINES, repeated_paragraphs, without_repeats
from eventlake.llm.passages import PASSAGE, without_passages
from eventlake.llm.queries import op1_paragraph_dedup
from llm.conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, least=1):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if len(w) < least:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def parts_of(sets):
    """Component number of each set; empty sets are alone."""
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    first = {}
    for i, s in enumerate(sets):
        if s:
            up[i] = top(first.setdefault(s, i))
    holders = defaultdict(set)
    for s, i in first.items():
        for x in s:
            holders[x].add(i)
    for a, b in {p for h in holders.values() for p in combinations(sorted(h), 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            up[top(a)] = top(b)
    return [top(i) for i in range(len(sets))]


def test_documents_match_brute_force(corpus):
    rows = corpus.select("doc_id", "text").collect()
    sets = [shingles(r.text) for r in rows]
    part = parts_of(sets)
    least = {}
    for r, p in zip(rows, part, strict=True):
        if r.doc_id is not None:
            least[p] = min(least.get(p, r.doc_id), r.doc_id)
    expected = sorted((repr(r.doc_id), len(s), repr(least.get(p)) if s else repr(r.doc_id)) for r, s, p in zip(rows, sets, part, strict=True))
    found = similar_documents(corpus)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = found.collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_chained_copies(spark):
    """Neighbours in a chain are similar, its ends are not: one component, over many blocks."""
    rng = random.Random(5)
    w = [f"a{rng.random()}" for _ in range(80)]
    rows = []
    for i in range(160):
        w[i % 80] = f"b{i}"
        rows.append((i, " ".join(w)))
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    part = parts_of([shingles(t) for _, t in rows])
    assert len({r.component_id for r in got}) == len(set(part))


def test_empty_tables(nothing):
    assert similar_documents(nothing).count() == 0
    assert without_near_duplicates(nothing).count() == 0
    assert without_repeats(nothing).count() == 0


def test_one_row_of_each_component_stays(corpus):
    rows = corpus.select("doc_id", "text").collect()
    sets = [shingles(r.text) for r in rows]
    part = parts_of(sets)
    kept = without_near_duplicates(corpus)
    assert kept.schema == corpus.schema
    worded = {p for p, s in zip(part, sets, strict=True) if s}
    bare = sum(not s for s in sets)
    got = kept.select("doc_id", "text").collect()
    assert len(got) == len(worded) + bare
    assert {shingles(r.text) for r in got if shingles(r.text)} <= set(sets)


def test_banding_has_high_recall():
    for banding in (TEXTS, LINES):
        missed = (1 - 0.75**banding.rows) ** banding.bands
        assert missed < 0.002


def test_components_against_plain_union(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(7, x) for x in range(500, 700)] + [(9, 9), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    assert found == {x: top(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_paragraphs_match_brute_force(corpus):
    docs = {(r.doc_id, r.text) for r in corpus.select("doc_id", "text").where("text is not null").collect()}
    # the text's key orders rows that share an id; here only null ids do
    lines = [(d is None, d or 0, t, no, line) for d, t in docs for no, line in enumerate(t.split("\n"))]
    sets = [shingles(line, LINES.least_words) for *_, line in lines]
    part = parts_of(sets)
    groups = defaultdict(list)
    for p, s, row in zip(part, sets, lines, strict=True):
        if s:
            groups[p].append(row)
    expected = {(r[1], r[3]) for g in groups.values() for r in g if r[:4] != min(g)[:4] and not r[0]}
    found = {(r.doc_id, r.no) for r in repeated_paragraphs(corpus).collect() if r.doc_id is not None}
    # first rows with an id are decided by it alone
    assert found == expected


def test_texts_lose_only_repeats(corpus):
    cleaned = without_repeats(corpus, removed_column="removed")
    assert cleaned.columns == [*corpus.columns, "removed"]
    before = {r.doc_id: r.text for r in corpus.where("doc_id is not null").collect()}
    for r in cleaned.where("doc_id is not null").collect():
        if before[r.doc_id] is None:
            assert r.text is None and r.removed == []
            continue
        left = [line for i, line in enumerate(before[r.doc_id].split("\n")) if i not in r.removed]
        assert r.text == "\n".join(left)
    assert cleaned.count() == corpus.count()
    assert without_repeats(corpus).schema == corpus.schema


def test_a_paragraph_repeated_in_one_text(spark):
    line = " ".join(f"word{i}" for i in range(20))
    rows = spark.createDataFrame([(1, f"{line}\nshort\n{line}\nshort"), (2, f"x\n{line}")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in without_repeats(rows).collect()} == {1: f"{line}\nshort\nshort", 2: "x"}
    assert without_repeats(rows).where(F.col("text").isNull()).count() == 0


def plain_passages(docs):
    """Each text's words without the runs that an equal run comes before; docs: (id, text)."""
    first, out = {}, {}
    for d, text in sorted(docs):
        w = WORD.findall(text)
        gone = [False] * len(w)
        for i in range(len(w) - PASSAGE + 1):
            at = first.setdefault(tuple(x.lower() for x in w[i : i + PASSAGE]), (d, i))
            if at[0] != d or i - at[1] >= PASSAGE:
                gone[i : i + PASSAGE] = [True] * PASSAGE
        out[d] = [x for x, g in zip(w, gone, strict=True) if not g]
    return out


@pytest.mark.parametrize("hot", [passages.HOT, 1])
def test_passages_below_and_across_lines(spark, monkeypatch, hot):
    """A passage in the middle of long lines, one wrapped at 8 words, and one in part only."""
    monkeypatch.setattr(passages, "HOT", hot)
    long, wrapped = words(1, 60), words(2, 60)
    lines = "\n".join(" ".join(wrapped[i : i + 8]) for i in range(0, 60, 8))
    rows = [(i, " ".join(words(10 + i, 150) + long + words(50 + i, 150))) for i in range(3)]
    rows += [(i, f"{' '.join(words(10 + i, 40))}\n{lines}\nend{i} of it") for i in (3, 4)]
    rows += [(5, " ".join(words(6, 30) + wrapped[10:50] + words(7, 30))), (6, "Again " * 90), (7, " ".join(long)), (8, " ".join(long[:24]))]
    docs = spark.createDataFrame([(*r, "x") for r in rows] + [(None, " ".join(words(8, 9) + long), "x"), (9, None, "x")], "doc_id long, text string, removed string")
    assert without_repeats(docs).where("doc_id = 1").first().text == rows[1][1]  # lines alone leave it
    found = without_passages(docs, "passages").collect()
    got = {r.doc_id: r.text for r in found}
    assert got[0] == rows[0][1] and got[8] == rows[8][1] and got[9] is None
    assert got[1] == " ".join(words(11, 150) + words(51, 150)) and got[None] == " ".join(words(8, 9))
    assert got[4] == f"{' '.join(words(14, 40))}\nend4 of it" and got[7] == ""
    assert got[5] == " ".join(words(6, 30) + words(7, 30)) and got[6].split() == ["Again"] * PASSAGE
    assert {d: WORD.findall(got[d]) for d, _ in rows} == plain_passages(rows)
    before = dict(rows)
    for r in found:
        if r.doc_id in before:
            data = before[r.doc_id].encode()
            assert len(r.text.encode()) == len(data) - sum(c.end - c.start for c in r.passages)
    assert without_passages(docs).schema == docs.schema


@pytest.mark.parametrize("hot", [passages.HOT, 1])
def test_passages_match_brute_force(spark, nothing, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)  # at 1 every shared run goes by pieces
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: WORD.findall(r.text) for r in without_passages(docs).collect()} == plain_passages(rows)
    assert without_passages(nothing).count() == 0


def test_the_query_and_the_pipeline_cut_passages(spark, tmp_path):
    shared = words(3, 60)
    rows = [(i, " ".join(words(70 + i, 200) + shared + words(90 + i, 200)), "en", "src", 1) for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(words(4, 40)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = " ".join(words(71, 200) + words(91, 200))
    got = {r.doc_id: r for r in op1_paragraph_dedup(spark, str(tmp_path)).collect()}
    assert got[0].text == rows[0][1] and got[1].text == left and got[1].removed == [] and len(got[1].passages) == 1
    docs = off_the_benchmark(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {0: (rows[0][1], len(rows[0][1])), 1: (left, len(left))}


def test_sizes_rule_out_by_the_asked_percent():
    members = [{"sig": bytes(128), "n": n} for n in (65, 100)]
    parts = _Parts([0, 1])
    assert list(_agreeing(members, parts, 0.5, 60)) == [(0, 1)]
    assert list(_agreeing(members, parts, 0.5, 75)) == []
