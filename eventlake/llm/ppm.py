"""Language identification by prediction by partial matching over byte contexts.

For each language a context tree of variable order holds how often each byte
followed each context of up to `ORDER` bytes. Escape method C: in a context with
n followers of d kinds, a byte seen c times there has probability c / (n + d), and
the escape to the next shorter context d / (n + d); below the empty context all
bytes are equally likely. The statistics are frozen after training, so the code
length of a byte depends on its context alone: all code lengths are worked out
once, and scoring a text is a walk down one shared tree of contexts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import release, slices, text_column, with_fields, written

#: Longest context, in bytes.
ORDER = 4
#: Documents per language that the statistics are gathered from, on average; fewer if there are fewer.
FIT_ROWS = 6_000
#: Contexts of the tree at most, dealt out in turn: every language has an equal share at least for its own most frequent ones.
CONTEXTS = 12_000
#: The symbol before the first byte of a text; no UTF-8 text holds this byte.
BEFORE = 0xFF
#: Scores below this are no certain language.
CERTAIN = 0.5
#: A text is in none of the languages if its code in the likeliest is this many bits longer than its bytes
#: as they are. Numbers and keys in a short text come to some 110 bits, 20 letters of another script to more.
FOREIGN = 256


@dataclass(frozen=True)
class Model:
    """languages; symbol[byte]; bits[context * kinds + symbol, language]; child[context * kinds + symbol before it]: the longer context.

    Bytes that training never saw are alike in every context and share symbol 0.
    """

    languages: list[str]
    symbol: np.ndarray
    bits: np.ndarray
    child: np.ndarray

    @property
    def kinds(self) -> int:
        return int(self.symbol.max()) + 1


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte, its ORDER + 1 bytes up to itself as one number, the nearest context byte above the farther ones."""
    padded = np.full(len(data) + ORDER * (len(offsets) - 1), BEFORE, np.uint8)
    at = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    padded[at] = data
    code = padded[at].astype(np.int64)
    for distance in range(1, ORDER + 1):
        code = code << 8 | padded[at - distance]
    return code


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each run of ORDER + 1 bytes occurs, by language."""
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in np.unique(langs):
            rows = np.flatnonzero(langs == lang)
            parts, seen = [], 0
            for r in [*rows, None]:
                if r is not None:
                    part = data[offsets[r] : offsets[r + 1]]
                    parts.append(part)
                    seen += len(part)
                if parts and (r is None or seen > 1 << 22):
                    grams, counts = np.unique(_grams(np.concatenate(parts), np.cumsum([0, *map(len, parts)])), return_counts=True)
                    yield pa.record_batch([pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])
                    parts, seen = [], 0


def gram_counts(rows: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(lang, gram, n) over the whole texts of about `fit_rows` rows of each language. rows: text, lang, and anything else."""
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("rows")), "language-sizes")
    # the text's own hash decides, not its place or a random number, so a retried task takes the same rows
    chance = F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(1_000_000)) / 1e6
    # no hint: the sizes are broadcast if their table is found to be small, else joined by shuffling
    taken = rows.join(sizes, "lang").where(chance < F.lit(float(fit_rows)) / F.col("rows"))
    # a text that is copied many times counts once, so that the sample keeps its bound
    counted = taken.select("lang", "text").distinct().mapInArrow(_count, "lang string, gram bigint, n bigint")
    return written(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, contexts: int = CONTEXTS) -> Model:
    """The frozen model of `rows` (text, lang; none null).

    The counts are made on the executors. All languages are learnt; each in turn
    adds its next most frequent context (the shorter first among equals, so a
    context comes with its shorter ones) until there are `contexts`. The driver
    takes those and their followers only. Without rows the model has no language.
    """
    grams = gram_counts(rows, fit_rows)
    languages = sorted(r[0] for r in grams.select("lang").distinct().collect())
    # numbers instead of names, so that what the driver takes is columns of numbers
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") if languages else F.lit(0)
    grams = grams.select(number.alias("lang"), "gram", "n")
    # one row for each context of each order: its bytes, nearest first, below a leading 1
    symbol = F.shiftright("gram", 8 * ORDER).cast("int").alias("symbol")
    orders = [(F.shiftright(F.col("gram").bitwiseAND((1 << 8 * ORDER) - 1), 8 * (ORDER - k)) + (1 << 8 * k)).alias("context") for k in range(ORDER + 1)]
    followed = None
    for context in orders:
        one = grams.select("lang", context, symbol, "n").groupBy("context", "lang", "symbol").agg(F.sum("n").alias("n"))
        followed = one if followed is None else followed.unionAll(one)
    followed = written(followed, "followers")
    of_language = Window.partitionBy("lang").orderBy(F.desc("n"), "context")
    ranked = followed.groupBy("context", "lang").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(of_language))
    # all languages' first contexts, then all their second ones: those that they share leave room for more
    frequent = ranked.where(F.col("place") <= contexts).groupBy("context").agg(F.min("place").alias("place")).orderBy("place", "context").limit(contexts).select("context")
    kept = followed.join(F.broadcast(written(frequent, "contexts")), "context").select("context", "lang", "symbol", "n").toArrow()
    columns = [kept.column(c).to_numpy() for c in ("context", "lang", "symbol", "n")]
    return _freeze(languages, columns[0], columns[1] - 1, columns[2], columns[3])


def _freeze(languages: list[str], context: np.ndarray, lang: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Model:
    names = np.unique(context)
    order = np.array([(int(c).bit_length() - 1) // 8 for c in names], np.int64)
    # a context counts only if all shorter ones are there too
    known, place = {1}, {1: 0}
    for c in names[np.argsort(order, kind="stable")]:  # so a context's place is above its shorter one's
        if int(c) != 1 and _shorter(int(c)) in known:
            known.add(int(c))
            place[int(c)] = len(place)
    total, voices = len(place), max(1, len(languages))
    used = np.union1d(np.unique(symbol), [BEFORE])
    letter = np.zeros(256, np.int64)
    letter[used] = np.arange(1, len(used) + 1)
    kinds_of_byte = len(used) + 1
    counts = np.zeros((total, kinds_of_byte, voices), np.float32)
    where = np.array([place.get(int(c), -1) for c in names], np.int64)
    at = where[np.searchsorted(names, context)] if len(names) else np.zeros(0, np.int64)
    keep = at >= 0
    counts[at[keep], letter[symbol[keep]], lang[keep]] = n[keep]
    bits = counts  # made context by context in the same memory; shorter contexts come first
    child = np.repeat(np.arange(total, dtype=np.int32) + total, kinds_of_byte).reshape(total, kinds_of_byte)
    for c, i in place.items():
        own = counts[i].copy()
        seen, kinds = own.sum(axis=0), (own > 0).sum(axis=0)
        if c == 1:
            below = np.full((kinds_of_byte, voices), 1 / 256, np.float32)
        else:
            parent = place[_shorter(c)]
            below = np.exp2(-bits[parent])
            child[parent, letter[c & 255]] = i
        with np.errstate(invalid="ignore", divide="ignore"):
            chance = np.where(own > 0, own / (seen + kinds), below * (kinds / (seen + kinds)))
        bits[i] = -np.log2(np.where(seen > 0, chance, below))
    ended = np.repeat(np.arange(total, dtype=np.int32) + total, kinds_of_byte)
    return Model(languages, letter.astype(np.uint8), bits.reshape(total * kinds_of_byte, voices), np.concatenate([child.ravel(), ended]))


def _shorter(context: int) -> int:
    """The context without its farthest byte: bytes are held nearest first below a leading 1."""
    order = (context.bit_length() - 1) // 8
    return (context - (1 << 8 * order) >> 8) + (1 << 8 * (order - 1))


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every row in every language."""
    kinds = np.int32(model.kinds)
    total = len(model.child) // kinds // 2
    padded = np.full(len(data) + ORDER * (len(offsets) - 1), model.symbol[BEFORE], np.int32)
    at = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    padded[at] = model.symbol[data]
    node = np.zeros(len(data), np.int32)
    for distance in range(1, ORDER + 1):
        # a walk that has ended stays where it is: the second half of the table
        node = model.child[node * kinds + padded[at - distance]]
    node[node >= total] -= total
    bits = model.bits[node * kinds + padded[at]]
    out = np.zeros((len(offsets) - 1, bits.shape[1]))
    rows = np.flatnonzero(np.diff(offsets) > 0)
    if len(rows):
        out[rows] = np.add.reduceat(bits, offsets[:-1][rows], axis=0, dtype=np.float64)
    return out


def _predict(model: Model, text: str, keep: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch.column(text))
            heard = np.array(batch.column("__letter").to_pylist(), bool)
            for first, end in slices(offsets):
                part, at = data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
                bits = code_lengths(model, part, at)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                posterior = 1 / np.exp2(np.clip(least[:, None] - bits, -1000, 0)).sum(axis=1)
                bits_of = least / np.maximum(1, np.diff(at))
                names, scores, lengths = [], [], []
                for row in range(end - first):
                    known = bool(heard[first + row]) and bool(model.languages)
                    names.append(model.languages[best[row]] if known else "und")
                    scores.append(float(posterior[row]) if known else 0.0)
                    lengths.append(float(bits_of[row]) if known else None)
                own = batch.slice(first, end - first)
                yield pa.record_batch([*[own.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())], names=[*keep, "lang_pred", "score", "bits_per_byte"])
        # what other operators' texts took is given back as well
        release()

    return predict


def identify(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns of every row with lang_pred, score and bits_per_byte of its whole text.

    lang_pred has the shortest code; score is its posterior when all languages
    are equally likely before. A null text, or one without a letter, is `und` at
    score 0, as is every text if the model has no language. Ties go to the first
    language in order. `keep` must not hold the three result names.
    """
    keep = ["doc_id"] if keep is None else keep
    # the text travels once, and letters are looked for natively, so that Python sees one flag
    letter = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False)).alias("__letter")
    rows = docs.select(*keep, *([] if text_column in keep else [text_column]), letter)
    return rows.mapInArrow(_predict(model, text_column, keep), with_fields(rows, keep, "lang_pred string, score double, bits_per_byte double"))


def training_rows(docs: DataFrame, learn, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """text and lang of the rows that `learn` (a condition) admits and that have both."""
    return docs.where(learn).select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where("text is not null and lang is not null")
