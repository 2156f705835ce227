"""From raw documents to token ids: five stages, each a written table for the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import ppm
from eventlake.llm.bpe import token_digests
from eventlake.llm.decontaminate import leaking_texts, without_leaks
from eventlake.llm.minhash import without_near_duplicates
from eventlake.llm.paragraphs import without_repeats
from eventlake.llm.passages import without_passages
from eventlake.llm.queries import PATTERN, RANKS
from eventlake.llm.tables import alone, drop_unused, scratch, table, text_key, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table's own labels teach.

    Rejected are texts without a letter (null and empty ones too), those whose
    likeliest language has a posterior below one half, and those unlike all of
    them: in the likeliest the code is longer than the plain bytes by more than
    ppm.FOREIGN bits. Copies and repeated rows fare alike. If no row has a
    language, nothing can be recognised and only texts without a letter go.
    """
    model = ppm.fit(ppm.training_rows(docs, F.lit(True)))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # columns go by number meanwhile, as theirs may be named like the answers
    numbered = [f"column_{i}" for i in range(len(docs.columns))]
    text = numbered[docs.columns.index("text")]
    told = ppm.identify(docs.toDF(*numbered), model, text, numbered)
    longer = (F.col("bits_per_byte") - 8) * F.octet_length(text)
    sure = told.where((F.col("lang_pred") != "und") & (F.col("score") >= ppm.CERTAIN) & (longer <= ppm.FOREIGN))
    return sure.select(*numbered).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents, the one with the least doc_id; of rows that share it, one.

    Null texts and texts without words are in no group and stay.
    """
    return without_near_duplicates(docs)


def paragraphs_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated paragraphs and passages only where they come first; n_chars follows the text.

    Passages are looked for in what the lines taken out have left. There, documents
    that hold a passage of a benchmark item come after all others, so that none
    is kept only in a document that the next stage takes out. A document may
    become empty; it stays as a row.
    """

    def marked() -> DataFrame:
        lines = alone(lambda: written(without_repeats(docs), "lines-once"))
        leaking = alone(lambda: written(leaking_texts(lines, table(spark, sf_dir, "benchmark")).select(F.col("text_key").alias("__leaked")), "leaking"))
        found = lines.join(leaking, text_key("text") == F.col("__leaked"), "left")
        return written(found.withColumn("__last", F.col("__leaked").isNotNull()).drop("__leaked"), "lines-marked")

    return _counted(without_passages(alone(marked), last_column="__last").drop("__last"))


def _counted(docs: DataFrame) -> DataFrame:
    """The rows, their n_chars (if there is one) that of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length)


def off_the_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item, and of what they repeat word for word below or across lines only the first.

    The second comes after the first, so that no passage is kept only in a
    document that is taken out; behind the paragraphs stage it finds only what
    has become a repeat by cuts. Copies and repeated rows leak alike; of equal
    passages the one in the least doc_id stays.
    """
    clean = written(without_leaks(docs, table(spark, sf_dir, "benchmark")), "no-leaks")
    return _counted(without_passages(clean))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of token ids and decoded bytes of each document."""
    return token_digests(docs, RANKS, PATTERN)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Working tables of the stage before, which its result may still read.
_left: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, which first removes the working tables of the one before unless `docs` still reads them.

    A stage's rows are written before the next stage begins, so what it made on
    the way is done with. Results that are read later without having been
    written are not kept alive.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _left[:] = drop_unused(docs, _left)
        with scratch() as made:
            result = stage(spark, docs, sf_dir)
        _left.extend(made)
        return result

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language", _tidy(known_language)),
    ("near-duplicates", _tidy(one_of_each_group)),
    ("paragraphs", _tidy(paragraphs_once)),
    ("benchmark", _tidy(off_the_benchmark)),
    ("tokens", _tidy(token_ids)),
]

#: Learnt models, minimum hashing and the tokenizer are beyond SQL; tests/llm/test_llm_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
