"""Substring dedup: paragraphs that repeat, exactly or nearly, stay only where they come first.

Paragraphs are the lines of a text. Minima of their 5-word shingles are banded
for high recall, paragraphs that collide are verified on whole sets by their
exact Jaccard similarity, and the links' components decide what is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.minhash import Banding, component_of_keys, signed_units, similar_links
from eventlake.llm.tables import alone, text_key, written

#: Bands of three minima: a pair at a similarity of 0.75 shares none with a probability of 0.0014, at 0.85 of 0.00001.
#: Shorter paragraphs than ten words (headings, greetings, captions) may repeat.
LINES = Banding(12, 3, lines=True, least_words=10)


def repeated_paragraphs(docs: DataFrame, percent: int = 75, banding: Banding = LINES) -> DataFrame:
    """doc_id, text_key, no, kept_doc_id, kept_no of each paragraph to remove; the kept one is its component's first.

    Paragraphs come in the order of doc_id (null ids last), then of the text's
    own key, then of their number. Rows with the same id and text are one
    document. A paragraph that repeats inside one document counts too.
    """
    named = docs.select("doc_id", text_key("text").alias("text_key"), "text").where("text is not null")
    signed = signed_units(named, banding, ["doc_id", "text_key"])
    roots = alone(lambda: component_of_keys(similar_links(signed, named, banding, percent)))
    place = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_key", "no").alias("place")
    first = signed.select("key", place).groupBy("key").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    # a paragraph that is alone, itself and its links, takes no further part
    first = first.join(roots, "key", "left").where("n > 1 or root is not null").select("key", F.coalesce("root", "key").alias("root"), "place")
    first = written(first, "first-of-key")
    kept = written(first.groupBy("root").agg(F.min("place").alias("kept")), "first-of-component")
    known = written(first.select("key", "root").join(kept, "root").select("key", "kept"), "kept")
    found = signed.select("key", "doc_id", "text_key", "no", place).join(known, "key").where("place <> kept")
    return found.select("doc_id", "text_key", "no", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.no").alias("kept_no")).distinct()


def without_repeats(docs: DataFrame, percent: int = 75, banding: Banding = LINES, removed_column: str | None = None) -> DataFrame:
    """Every row of `docs` and all its columns, repeated paragraphs taken out of column text.

    The other paragraphs stay as they are, joined by line ends; a text that
    loses every paragraph becomes empty, a null text stays null. With
    `removed_column`, a column of that name holds the numbers of the paragraphs
    removed. Empty tables stay empty.
    """

    def removals() -> DataFrame:
        own, gone = F.struct("doc_id", "text_key"), F.sort_array(F.collect_set("no")).alias("__gone")
        removed = repeated_paragraphs(docs, percent, banding)
        return written(removed.groupBy(F.xxhash64(own).alias("__place"), own.alias("__own")).agg(gone), "removals")

    lists = alone(removals)
    keyed = docs.withColumn("__own_row", F.struct(F.col("doc_id"), text_key("text").alias("text_key")))
    joined = keyed.hint("merge").join(lists, F.xxhash64("__own_row").eqNullSafe(F.col("__place")) & F.col("__own_row").eqNullSafe(F.col("__own")), "left")
    left = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col("__gone"), i.cast("bigint")))
    cleaned = joined.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    if removed_column:
        cleaned = cleaned.withColumn(removed_column, F.coalesce("__gone", F.array().cast("array<bigint>")))
    return cleaned.drop("__own_row", "__place", "__own", "__gone")
