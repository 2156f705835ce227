"""Passages: runs of words that repeat word for word stay only where they come first, wherever lines begin and end.

Every run of `PASSAGE` words hands on the least hash of its shorter runs of
`GRAM` words (winnowing), about one value for seven words. Equal runs hand on
equal values, so a run whose value occurs once in the table has no other copy.
The rest are compared by two independent 64-bit hashes of the whole run. Runs
of a very frequent value are dealt out by document, compared in pieces first, and
only the first of each piece are compared with one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import alone, bit_filter, in_filter, release, slices, text_column, with_fields, written
from eventlake.llm.words import mix, window_hashes, word_hashes

#: Words of the shortest repeat that is cut.
PASSAGE = 25
#: Words of the runs whose least hash stands for a passage.
GRAM = 13
#: A print at more places than this is hot; runs with a hot print are dealt out into so many pieces.
HOT, PIECES = 2_000, 64
#: Added to the words' hashes for the second hash of a run.
CHECK = np.uint64(0x6A09E667F3BCC909)


def _least_grams(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every run of PASSAGE words inside one row, where its least gram begins (the first of equals), and all grams' hashes."""
    grams = window_hashes(words, GRAM)
    runs = len(words) - PASSAGE + 1
    if runs <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    least, width, span = np.arange(len(grams)), 1, PASSAGE - GRAM + 1
    while width < span:
        step = min(width, span - width)
        left, right = least[:-step], least[step:]
        least = np.where(grams[right] < grams[left], right, left)
        width += step
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(row[:runs] == row[PASSAGE - 1 :])
    return starts, least[starts], grams


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(print): the least grams of all runs, each place once."""
    for batch in batches:
        data, offsets = text_column(batch.column("__text"))
        for first, end in slices(offsets):
            words, counts, _, _ = word_hashes(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
            _, least, grams = _least_grams(words, counts)
            if len(least):
                yield pa.record_batch([pa.array(grams[least[np.concatenate(([True], least[1:] != least[:-1]))]].view(np.int64))], names=["print"])
    release()


def _runs(seen: np.ndarray, hot: np.ndarray):
    """(carried, run, check, at, piece): the runs whose print may occur twice, by two hashes, and the number of their first word.

    piece is 0, or for a print that may be hot one of 1 to PIECES by the document.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = [c for c in batch.schema.names if c != "__text"]
            data, offsets = text_column(batch.column("__text"))
            for first, end in slices(offsets):
                words, counts, _, _ = word_hashes(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                starts, least, grams = _least_grams(words, counts)
                if not len(starts):
                    continue
                new = np.concatenate(([True], least[1:] != least[:-1]))
                prints, print_of = grams[least[new]].view(np.int64), np.cumsum(new) - 1
                shared = in_filter(seen, prints)[print_of]
                starts, is_hot = starts[shared], in_filter(hot, prints)[print_of[shared]]
                if not len(starts):
                    continue
                ends = np.cumsum(counts)
                row = np.searchsorted(ends, starts, side="right")
                run = window_hashes(words, PASSAGE)[starts].view(np.int64)
                check = window_hashes(mix(words + CHECK), PASSAGE)[starts].view(np.int64)
                at = (starts - (ends - counts)[row]).astype(np.int32)
                rows = pa.array(row + first)
                own = batch.column("own").take(rows)
                piece = np.where(is_hot, 1 + (own.to_numpy().view(np.uint64) % np.uint64(PIECES)).astype(np.int32), 0).astype(np.int32)
                yield pa.record_batch([*[batch.column(c).take(rows) for c in carried], pa.array(run), pa.array(check), pa.array(at), pa.array(piece)], names=[*carried, "run", "check", "at", "piece"])
        release()

    return runs


def _own() -> Column:
    """64 bits of a text, which tell apart the texts of one doc_id."""
    return F.xxhash64(F.col("text").cast("binary"))


def _with_first(runs: DataFrame, keys: list[str], last: list[str]) -> DataFrame:
    """The runs with `same`, whether the first one of their `keys` lies in the same document, and `over`, whether they overlap it there.

    Runs are shuffled once and pass by in order, whatever number of copies they have.
    """
    copies = Window.partitionBy(*keys).orderBy(*last, F.col("doc_id").asc_nulls_last(), "own", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = runs.withColumn("first", F.first(F.struct("doc_id", "own", "at")).over(copies))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("own") == F.col("first.own"))
    return met.withColumn("over", same & (F.col("at") < F.col("first.at") + PASSAGE)).drop("first")


def repeated_passages(docs: DataFrame, last_column: str | None = None) -> DataFrame:
    """doc_id, own, at of each document with runs of PASSAGE words that an equal run comes before.

    own is 64 bits of the text, at the numbers of the runs' first words, each once and in order.

    Runs come in the order of doc_id (null ids last), then of `own`, then of their
    words. Rows with the same id and text are one document. A run that overlaps
    its own first copy stays, so a word said again and again is not lost. Texts
    for which boolean column `last_column` is true come after all others.

    A hot run has a first copy in each of PIECES pieces, dealt by document. What
    is not that first copy, and does not overlap it, has an earlier copy and is
    settled; the others, at most PASSAGE for each piece of a run, are compared
    once more over all pieces.
    """
    last = [last_column] if last_column else []
    texts = docs.where("text is not null").select("doc_id", _own().alias("own"), *last, F.col("text").alias("__text"))
    prints = texts.select("__text").mapInArrow(_prints, "print bigint")
    shared = written(prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1"), "shared-prints")
    seen, hot = bit_filter(shared.select("print")), bit_filter(shared.where(F.col("n") > HOT).select("print"))
    carried = ["doc_id", "own", *last]
    runs = texts.mapInArrow(_runs(seen, hot), with_fields(texts, carried, "run bigint, check bigint, at int, piece int"))
    met = _with_first(runs, ["run", "check", "piece"], last).where("not over or piece > 0")
    settled, left = F.when(~F.col("over"), F.col("at")), F.when(F.col("over"), F.struct("run", "check", "at"))
    found = met.groupBy(*carried).agg(F.collect_set(settled).alias("at"), F.collect_set(left).alias("left"))
    found = written(found, "repeated")
    # the firsts of all pieces of the hot runs
    firsts = _with_first(found.select(*carried, F.explode("left").alias("run")).select(*carried, "run.*"), ["run", "check"], last)
    late = firsts.where("not over").groupBy(*carried).agg(F.collect_set("at").alias("at"))
    both = found.select(*carried, "at").where(F.size("at") > 0).unionAll(late)
    return both.groupBy("doc_id", "own").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"))


def _cut(data: bytes, at: list[int]) -> tuple[bytes, list[dict]]:
    """The text without the runs that begin at these words, and the bytes that were cut; white space beside a cut stays once."""
    _, _, starts, ends = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    gone = np.zeros(len(starts) + 1, np.int64)
    np.add.at(gone, np.array(at), 1)
    np.add.at(gone, np.array(at) + PASSAGE, -1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(gone) > 0)).astype(np.int8)))
    left, cuts, done = [], [], 0
    for word, after in zip(edge[::2], edge[1::2], strict=True):
        start, end = int(starts[word]), int(ends[after - 1])
        if start == 0 or data[start - 1] == 10:
            # from the beginning of a line: the white space behind goes too
            end = min(end + 1, len(data))
        else:
            start -= 1
        left.append(data[done:start])
        cuts.append({"start": start, "end": end})
        done = end
    return b"".join([*left, data[done:]]), cuts


def _without(names: list[str]):
    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column("text").to_pylist(), [[]] * batch.num_rows
            for row, at in enumerate(batch.column("__at").to_pylist()):
                if at:
                    cut, cuts[row] = _cut(texts[row].encode(), at)
                    texts[row] = cut.decode()
            made = {"text": pa.array(texts, batch.schema.field("text").type), "__cuts": pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
            yield pa.record_batch([made[c] if c in made else batch.column(c) for c in names], names=names)
        release()

    return without


def without_passages(docs: DataFrame, removed_column: str | None = None, last_column: str | None = None) -> DataFrame:
    """Every row of `docs` and all its columns, repeated passages cut out of column text.

    With `removed_column`, a column of that name holds the first byte and the end
    of each cut in the text as it came in. A null text stays null; a text that
    is one repeat becomes empty. Of equal passages the one in a text for which
    boolean column `last_column` is true stays only if no other text has it.
    `docs` is read three times: it should be a written table. Empty tables stay empty.
    """
    names = [F.col(name).alias(f"__{to}") for name, to in (("doc_id", "id"), ("own", "own"), ("at", "at"))]
    lists = alone(lambda: written(repeated_passages(docs, last_column).select(*names), "passages"))
    # repeated ids and null ones are told apart by their texts
    joined = docs.hint("merge").join(lists, (_own() == F.col("__own")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    rows = joined.select(*docs.columns, "__at")
    cut = rows.mapInArrow(_without([*docs.columns, "__cuts"]), with_fields(rows, docs.columns, "__cuts array<struct<start:bigint,end:bigint>>"))
    return cut.withColumnRenamed("__cuts", removed_column) if removed_column else cut.drop("__cuts")
