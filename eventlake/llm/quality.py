"""Document quality from overlapping heuristics without given labels.

Each heuristic votes good, bad or nothing on a text. Expectation-maximisation
over the counts of vote patterns estimates how often each one is right, and so
how likely each pattern is to come from a good text. Those posteriors are the
labels on which a linear scorer over hashed words and text measures is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import slices, text_column, with_fields, written
from eventlake.llm.words import distinct_sorted, word_hashes

#: Hashed features of words; measures have a range of their own below.
BITS = 18
#: Texts that the scorer is fitted on, on average; fewer if there are fewer.
FIT_ROWS = 6000
ROUNDS = 60
#: Bounds between the classes a measure is put into as a feature.
CLASSES = 12

#: Measures of a text: (name, bad below, good from, good up to, bad above, whether it can vote good); between
#: the bounds a heuristic has no vote. The absence of one kind of junk is no sign of quality.
#: Fixed values, set by what running prose looks like in any script.
MEASURES = (
    ("letters", 0.80, 0.90, 1.0, 1.0, False),
    ("word_length", 2.0, 2.8, 11.0, 16.0, True),
    ("capitals", -1.0, 0.0, 0.20, 0.50, False),
    ("distinct_words", 0.15, 0.30, 1.0, 1.0, False),
    ("distinct_lines", 0.50, 0.85, 1.0, 1.0, True),
    ("bare_symbols", -1.0, 0.0, 0.03, 0.12, False),
    ("repeated_words", -1.0, 0.0, 0.03, 0.10, False),
    ("sentence_ends", -1.0, 0.01, 0.35, 0.80, True),
    ("symbols", -1.0, 0.0, 0.01, 0.05, True),
    ("marked_words", -1.0, 0.0, 0.02, 0.10, True),
    ("small_words", 0.35, 0.60, 1.0, 1.0, True),
)
#: Below this many words a measure of words is no evidence.
FEW = 12

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SMALL = np.zeros(256, bool)
_SMALL[97:123] = _SMALL[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"!#$%&*+/<=>@\\^_`{|}~")] = True
_END = np.zeros(256, bool)
_END[[33, 46, 63]] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[128:192] = True


def measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows x MEASURES) values, NaN without words; the words' hashes; the number of words of each row."""
    words, counts, starts, ends = word_hashes(data, offsets)
    out = np.full((len(counts), len(MEASURES)), np.nan)
    if not len(words):
        return out, words, counts
    sums = lambda flags: np.concatenate(([0], np.cumsum(flags)))
    letters, capitals, continues = sums(_LETTER[data]), sums(_CAPITAL[data]), sums(_CONTINUES[data])
    row_end = np.cumsum(counts)
    row_start = row_end - counts
    of_row = lambda per_word: sums(per_word)[row_end] - sums(per_word)[row_start]
    size, letter = ends - starts, letters[ends] - letters[starts]
    again = np.concatenate(([False], words[1:] == words[:-1]))
    again[row_start[(counts > 0) & (row_start < len(words))]] = False
    n = np.maximum(counts, 1)
    visible = np.maximum(of_row(size), 1)
    out[:, 0] = of_row(letter) / visible
    out[:, 1] = (visible - (continues[offsets[1:]] - continues[offsets[:-1]])) / n
    out[:, 2] = (capitals[offsets[1:]] - capitals[offsets[:-1]]) / np.maximum(of_row(letter), 1)
    out[:, 5] = of_row(letter == 0) / n
    out[:, 6] = of_row(again) / n
    out[:, 7] = of_row(_END[data[ends - 1]]) / n
    symbols = sums(_SYMBOL[data])
    out[:, 8] = (symbols[offsets[1:]] - symbols[offsets[:-1]]) / visible
    out[:, 9] = of_row(symbols[ends] > symbols[starts]) / n
    out[:, 10] = of_row(_SMALL[data[starts]]) / n
    for row in np.flatnonzero(counts):
        own = words[row_start[row] : row_end[row]]
        # of the first word's kinds in each thousand, so that long texts do not look poor
        pieces = [own[k : k + 1000] for k in range(0, len(own), 1000)]
        out[row, 3] = np.mean([len(distinct_sorted(p)) / len(p) for p in pieces])
        lines = [line for line in data[offsets[row] : offsets[row + 1]].tobytes().split(b"\n") if line.strip()]
        out[row, 4] = len(set(lines)) / len(lines)
    out[counts == 0] = np.nan
    return out, words, counts


def votes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 no vote, of each heuristic on each row; few words are no evidence, none are bad by all."""
    out = np.full(values.shape, 2, np.int64)
    for k, (_, worst, low, high, top, speaks) in enumerate(MEASURES):
        x = values[:, k]
        out[(x >= low) & (x <= high), k] = 1 if speaks else 2
        out[(x < worst) | (x > top), k] = 0
    out[(counts > 0) & (counts < FEW)] = 2
    out[counts == 0] = 0
    return out


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = 3 ** np.arange(len(MEASURES))
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        for first, end in slices(offsets):
            at = offsets[first : end + 1] - offsets[first]
            values, _, counts = measures(data[offsets[first] : offsets[end]], at)
            patterns, n = np.unique(votes(values, counts) @ place, return_counts=True)
            yield pa.record_batch([pa.array(patterns), pa.array(n)], names=["pattern", "n"])


def _unfold(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(MEASURES)) % 3


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and the chance of each vote of each heuristic on bad and on good texts."""

    good: float
    chance: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance that a text with these votes is good; no votes at all give the share of good texts."""
        voices = np.arange(votes.shape[1])
        logs = np.log(self.chance)
        # a heuristic that keeps silent says nothing
        said = votes != 2
        bad = np.log(1 - self.good) + (logs[0][voices, votes] * said).sum(axis=1)
        good = np.log(self.good) + (logs[1][voices, votes] * said).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation from the first guess that a text with a bad vote is bad; heuristics are independent given the quality, and no one is taken as worse than chance."""
    seen = _unfold(patterns)
    voices = seen.shape[1]
    good = ((seen == 1).sum(axis=1) + 1.0) / ((seen != 2).sum(axis=1) + 2.0)
    good = np.where((seen == 0).any(axis=1), 0.2 * good, np.clip(good, 0.5, 0.95))
    model = LabelModel(0.9, np.full((2, voices, 3), 0.5))
    for _ in range(rounds):
        chance = np.empty((2, voices, 3))
        for quality, weight in enumerate((n * (1 - good), n * good)):
            yes = (weight[:, None] * (seen == 1)).sum(axis=0) + (2.0 if quality else 1.0)
            no = (weight[:, None] * (seen == 0)).sum(axis=0) + (1.0 if quality else 2.0)
            chance[quality] = np.stack([no / (yes + no), yes / (yes + no), np.ones(voices)], axis=1)
        chance[1, :, 1] = np.maximum(chance[1, :, 1], chance[0, :, 1])
        chance[1, :, 0] = 1 - chance[1, :, 1]
        model = LabelModel(float(np.clip((n * good).sum() / n.sum(), 0.02, 0.98)), chance)
        good = model.posterior(seen)
    return model


@dataclass(frozen=True)
class Scorer:
    """label model; weight of each hashed word, of each class of each measure, and the base."""

    labels: LabelModel
    words: np.ndarray
    classes: np.ndarray
    base: float


def _classes(values: np.ndarray) -> np.ndarray:
    """Feature numbers of the measures' classes: even steps of the span between the bad bounds."""
    out = np.empty(values.shape, np.int64)
    for k, (_, worst, low, high, top, _) in enumerate(MEASURES):
        a, b = min(max(worst, 0.0), low), max(top, high)
        step = np.floor((values[:, k] - a) / max(b - a, 1e-9) * (CLASSES - 3)) + 1
        out[:, k] = np.where(np.isnan(step), CLASSES - 1, np.clip(step, 0, CLASSES - 2)) + k * CLASSES
    return out


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = 3 ** np.arange(len(MEASURES))
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        for first, end in slices(offsets):
            values, words, counts = measures(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
            ends = np.cumsum(counts)
            slots = _slots(words).astype(np.int32)
            yield pa.record_batch([pa.array(votes(values, counts) @ place), pa.array(_classes(values).tolist(), pa.list_(pa.int64())), pa.array([np.unique(slots[e - c : e]).tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary())], names=["pattern", "classes", "slots"])


def fit(docs: DataFrame, text_column: str = "text", fit_rows: int = FIT_ROWS) -> Scorer:
    """Accuracies from the votes on all texts, and a scorer from about `fit_rows` of them (bounded, taken by the text's hash).

    Vote patterns are counted on the executors: at most 3 to the power of the
    number of heuristics rows come to the driver. An empty table gives a scorer
    that finds everything good.
    """
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    counted = written(texts.mapInArrow(_patterns, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")), "patterns").toArrow()
    patterns, n = counted.column("pattern").to_numpy(), counted.column("n").to_numpy()
    total = int(n.sum())
    if not total:
        return Scorer(LabelModel(0.9, np.full((2, len(MEASURES), 3), 0.5)), np.zeros(1 << BITS, np.float32), np.zeros(len(MEASURES) * CLASSES), 2.0)
    labels = estimate(patterns, n.astype(np.float64))
    chance = F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(1_000_000)) / 1e6
    # a text that is copied many times counts once, so that the sample keeps its bound
    sample = texts.where(chance < fit_rows / total).distinct().mapInArrow(_training, "pattern bigint, classes array<bigint>, slots binary")
    rows = written(sample, "quality-sample").toArrow()
    if not rows.num_rows:
        return Scorer(labels, np.zeros(1 << BITS, np.float32), np.zeros(len(MEASURES) * CLASSES), float(np.log(labels.good / (1 - labels.good))))
    target = labels.posterior(_unfold(rows.column("pattern").to_numpy()))
    sets = [np.frombuffer(x.as_buffer(), np.int32) for x in rows.column("slots")]
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets).astype(np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    share = 1 / np.sqrt(np.maximum(sizes, 1))[owner]
    classes = np.array(rows.column("classes").to_pylist(), np.int64).reshape(rows.num_rows, -1)
    words, kinds, base = np.zeros(1 << BITS), np.zeros(len(MEASURES) * CLASSES), 0.0
    pull_w, pull_k, pull_b = np.full(len(words), 1e-6), np.full(len(kinds), 1e-6), 1e-6
    for _ in range(ROUNDS):
        margin = base + kinds[classes].sum(axis=1) + np.bincount(owner, weights=words[flat] * share, minlength=len(sets))
        error = target - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        slope_w = np.bincount(flat, weights=error[owner] * share, minlength=len(words)) - 0.5 * words
        slope_k = np.bincount(classes.ravel(), weights=np.repeat(error, classes.shape[1]), minlength=len(kinds)) - 0.1 * kinds
        pull_w += slope_w**2
        pull_k += slope_k**2
        pull_b += error.sum() ** 2
        words += 0.1 * slope_w / np.sqrt(pull_w)
        kinds += 0.3 * slope_k / np.sqrt(pull_k)
        base += 0.3 * error.sum() / np.sqrt(pull_b)
    return Scorer(labels, words.astype(np.float32), kinds, float(base))


def _score(scorer: Scorer):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [c for c in batch.schema.names if c != "__text"]
            data, offsets = text_column(batch.column("__text"))
            for first, end in slices(offsets):
                values, words, counts = measures(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                weak = scorer.labels.posterior(votes(values, counts))
                margin = scorer.base + scorer.classes[_classes(values)].sum(axis=1)
                slots, ends = _slots(words), np.cumsum(counts)
                for row in np.flatnonzero(counts):
                    own = np.unique(slots[ends[row] - counts[row] : ends[row]])
                    margin[row] += scorer.words[own].sum() / np.sqrt(len(own))
                own = batch.slice(first, end - first)
                yield pa.record_batch([*[own.column(c) for c in keep], pa.array(weak), pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))], names=[*keep, "weak_label", "score"])

    return score


def score_quality(docs: DataFrame, scorer: Scorer, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns of every row with weak_label (the votes' posterior) and score, both 0 to 1, of its whole text.

    Texts without words (null, empty, white space) are bad by every heuristic.
    `keep` must not hold the two result names; other columns are not read.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*keep, F.col(text_column).alias("__text"))
    return rows.mapInArrow(_score(scorer), with_fields(rows, keep, "weak_label double, score double"))
