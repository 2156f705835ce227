"""The pipeline's stages against a plain version of each on its own input."""

import hashlib
import random

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from eventlake.llm import bpe
from eventlake.llm.tables import written
from eventlake.sources.paths import exists
from llm.conftest import words
from llm.plain import least_of_components, paragraphs_left, plain_leaks
from llm.test_llm_near import WORD, plain_passages

SMALL = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    library = tiktoken.Encoding("own", pat_str=pipeline.PATTERN, mergeable_ranks=bpe._ranks(pipeline.RANKS), special_tokens={})
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = written(stage(spark, docs, SMALL), name)
        rows = {r.doc_id: r for r in after.collect()}
        if name != "tokens":
            assert after.columns == docs.columns
        if name == "language":
            assert len(rows) >= 0.99 * len(before)
        elif name == "near-duplicates":
            assert set(rows) == least_of_components(before)
        elif name == "paragraphs":
            assert {d: r.text for d, r in rows.items()} == paragraphs_left(before)
            assert all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "benchmark":
            assert set(rows) == set(before) - {d for d, _ in plain_leaks(list(before.items()), items)}
        else:
            for d, text in before.items():
                ids = library.encode_ordinary(text)
                assert rows[d].n_tokens == len(ids)
                assert rows[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                assert rows[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        docs = after
    whole = {tuple(r) for r in pipeline.run(spark, SMALL).collect()}
    assert whole == {tuple(r) for r in docs.collect()}


def test_stages_take_any_rows(spark, corpus, nothing):
    docs = corpus.withColumn("lang_pred", F.lit("x")).withColumn("row", F.lit(1)).withColumn("removed", F.lit(2))
    for table in (docs, nothing):
        left = table
        for name, stage in pipeline.STAGES:
            made = written(stage(spark, left, SMALL), name)
            if name != "tokens":
                assert made.columns == left.columns
            left = made
        assert (left.count() > 0) == (table is docs)
    told = pipeline.known_language(spark, docs, SMALL)
    assert told.where("text is null or not text rlike '\\\\p{L}'").count() == 0
    assert pipeline.known_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), SMALL).count() > 0


def test_other_languages_and_letters_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(2)
    foreign = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(40)),
    ]
    first = docs.agg(F.max("doc_id")).first()[0] + 1
    rows = [(first + k, text * times) for k, (text, times) in enumerate((t, n) for t in foreign for n in (1, 50))]
    others = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in pipeline.known_language(spark, docs.unionByName(others, allowMissingColumns=True), SMALL).select("doc_id").collect()}
    assert not left & {d for d, _ in rows}
    # of the given ones go only those too short to tell
    gone = [r for r in docs.collect() if r.doc_id not in left]
    assert all(len(r.text) < 20 for r in gone) and len(gone) < 0.002 * docs.count()


def test_working_tables_go_when_they_are_done_with(spark):
    """Those that a result not yet written reads are kept; the others go as the next stage begins."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    (_, near), (_, lines) = pipeline.STAGES[1:3]
    pipeline._left.clear()
    first = near(spark, docs, SMALL)
    made = list(pipeline._left)
    second = lines(spark, first, SMALL)  # chained without having been written
    kept = [path for path in made if exists(spark, path)]
    assert 0 < len(kept) < len(made)
    after = written(second, "lines")
    assert after.count() == first.count()
    made = list(pipeline._left)
    lines(spark, after, SMALL)
    assert not any(exists(spark, path) for path in made) and after.count() > 0


def test_the_paragraphs_stage_cuts_passages(spark, tmp_path):
    """Inside long lines and across short ones; a document that leaks gives way, though it comes first."""
    shared, item = words(3, 60), words(4, 60)
    lines = "\n".join(" ".join(shared[i : i + 8]) for i in range(0, 60, 8))
    rows = [(0, " ".join(words(70, 100) + item + words(71, 90) + shared + words(72, 100)))]
    rows += [(1, " ".join(words(73, 200) + shared + words(74, 200))), (2, f"{' '.join(words(75, 40))}\n{lines}\nend of it"), (3, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    made = written(pipeline.paragraphs_once(spark, docs, str(tmp_path)), "made")
    got = {r.doc_id: r for r in made.collect()}
    assert made.columns == docs.columns and len(got) == 4 and got[3].text is None
    assert got[0].text == " ".join(words(70, 100) + item + words(71, 90) + words(72, 100))
    assert got[1].text == rows[1][1] and got[2].text == f"{' '.join(words(75, 40))}\nend of it"
    assert all(r.n_chars == len(r.text or "") for r in got.values())
    left = {r.doc_id: r.text for r in pipeline.off_the_benchmark(spark, made, str(tmp_path)).collect()}
    assert left == {d: got[d].text for d in (1, 2, 3)}


def test_paragraphs_stage_against_plain_passages(spark):
    docs = written(spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null"), "docs")
    lines = written(pipeline.without_repeats(docs), "lines")
    texts = {r.doc_id: r.text for r in lines.collect()}
    clean = {r.doc_id for r in pipeline.without_leaks(lines, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    plain = plain_passages([((d not in clean, d), text) for d, text in texts.items()])
    assert plain != {(d not in clean, d): WORD.findall(text) for d, text in texts.items()}
    rows = pipeline.paragraphs_once(spark, docs, SMALL).collect()
    assert {(r.doc_id not in clean, r.doc_id): WORD.findall(r.text) for r in rows} == plain
