"""Toxic spans by a linear-chain conditional random field.

Each token is clean or toxic. A token's features are its word and the word's
first 3, 4 and 5 bytes and last 3, hashed; a weight for each, and one for each
pair of neighbouring states, make the field. Token labels for training come from
labelled documents: in a toxic one those tokens are toxic that have a feature
which clean documents hardly ever have. Marginals by forward-backward over whole
texts give spans, and their sum and maximum give a document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import slices, text_column, with_fields, written
from eventlake.llm.words import letter_tokens

#: Hashed features of each kind.
BITS = 17
KINDS = 5
#: Toxic documents used for fitting, on average, and four times as many clean ones; fewer if there are fewer.
FIT_ROWS, CLEAN = 1200, 4
#: A feature marks toxic tokens if so many times more toxic documents have it, in proportion, and the
#: likelihood ratio of its two rates to one common rate is above this logarithm: a chance of one in a million.
ODDS, SURE = 20.0, 14.0
#: Marginals up to this are nothing.
DOUBT = 0.1
#: Rounds of training, tokens of a training sequence, tokens of a block while scoring.
ROUNDS, SEQUENCE, BLOCK = 30, 96, 64
#: Tokens whose messages are in memory at a time while training.
PART_TOKENS = 100_000


@dataclass(frozen=True)
class Model:
    """weights[feature], transition[from, to], and the logistic link from a document's marginals to its score."""

    weights: np.ndarray
    transition: np.ndarray
    link: np.ndarray


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers (tokens x KINDS), tokens of each row, and the tokens' first and end bytes."""
    hashes, counts, starts, ends = letter_tokens(data, offsets, (3, 4, 5), 3)
    slot = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
    return slot + (np.arange(KINDS, dtype=np.int32) << BITS), counts, starts, ends


def _emission(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    total = weights[features[:, 0]].astype(np.float64)
    for k in range(1, features.shape[1]):
        total += weights[features[:, k]]
    return total


def _steps(score: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Transfer matrices exp(transition + emission of the target state), scaled; score: sequences x steps."""
    out = np.empty((*score.shape, 2, 2))
    high = np.maximum(score, 0)
    move = np.exp(transition)
    out[..., 0] = move[:, 0] * np.exp(-high)[..., None]
    out[..., 1] = move[:, 1] * np.exp(score - high)[..., None]
    return out


def marginals(score: np.ndarray, counts: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Probability of the toxic state for every token; rows of `counts` tokens follow one another."""
    return pair_marginals(score, counts, transition).sum(axis=1)


def pair_marginals(score: np.ndarray, counts: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Probabilities (tokens x 2) that a token is toxic and the one before it clean, or toxic too.

    Exact for any length in bounded steps: rows are cut into blocks, each block's
    transfer matrix is multiplied out side by side with all others, the blocks'
    ends are chained, and messages are then run inside all blocks at once. What
    comes before a row's first token is clean.
    """
    rows = np.flatnonzero(counts)
    if not len(rows):
        return np.zeros((0, 2))
    size = counts[rows]
    blocks = -(-size // BLOCK)
    first = np.cumsum(blocks) - blocks
    n = int(blocks.sum())
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    cell = np.repeat(first * BLOCK, size) + at
    steps = np.broadcast_to(np.eye(2), (n * BLOCK, 2, 2)).copy()
    steps[cell] = _steps(score, transition)
    steps = steps.reshape(n, BLOCK, 2, 2)
    product = steps[:, 0]
    for t in range(1, BLOCK):
        product = product @ steps[:, t]
        if t % 16 == 15:
            product = product / product.sum(axis=(1, 2), keepdims=True)
    # before the first token the state is clean
    ahead, behind = np.empty((n, 2)), np.empty((n, 2))
    now, then = np.tile([1.0, 0.0], (len(rows), 1)), np.ones((len(rows), 2))
    for k in range(int(blocks.max())):
        live = np.flatnonzero(blocks > k)
        ahead[first[live] + k] = now[live]
        now[live] = np.einsum("ri,rij->rj", now[live], product[first[live] + k])
        now[live] /= now[live].sum(axis=1, keepdims=True)
        last = first[live] + blocks[live] - 1 - k
        behind[last] = then[live]
        then[live] = np.einsum("rij,rj->ri", product[last], then[live])
        then[live] /= then[live].sum(axis=1, keepdims=True)
    forward = np.empty((n, BLOCK + 1, 2))
    forward[:, 0] = ahead
    for t in range(BLOCK):
        ahead = np.einsum("ri,rij->rj", ahead, steps[:, t])
        ahead /= ahead.sum(axis=1, keepdims=True)
        forward[:, t + 1] = ahead
    toxic = np.empty((n, BLOCK, 2))
    for t in range(BLOCK - 1, -1, -1):
        both = forward[:, t, :, None] * steps[:, t] * behind[:, None, :]
        toxic[:, t] = both[:, :, 1] / both.sum(axis=(1, 2))[:, None]
        behind = np.einsum("rij,rj->ri", steps[:, t], behind)
        behind /= behind.sum(axis=1, keepdims=True)
    return toxic.reshape(-1, 2)[cell]


def _sums(toxic: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A document's inputs to the link: 1, log(1 + sum), maximum and second maximum of its marginals.

    The sum leaves out what is below DOUBT, or a long clean text would add up to something.
    """
    out = np.zeros((len(counts), 4))
    out[:, 0] = 1
    ends = np.cumsum(counts)
    rows = np.flatnonzero(counts)
    if len(rows):
        starts = (ends - counts)[rows]
        out[rows, 1] = np.log1p(np.add.reduceat(np.maximum(toxic - DOUBT, 0), starts))
        out[rows, 2] = np.maximum.reduceat(toxic, starts)
        rest = toxic.copy()
        owner = np.repeat(np.arange(len(counts)), counts)
        peak = np.flatnonzero(toxic == out[owner, 2])
        rest[peak[np.unique(owner[peak], return_index=True)[1]]] = 0
        out[rows, 3] = np.maximum.reduceat(rest, starts)
    return out


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_column(batch.column("text"))
        for first, end in slices(offsets):
            features, counts, _, _ = _features(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
            ends = np.cumsum(counts)
            yield pa.record_batch([batch.column("label").slice(first, end - first), pa.array([features[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary())], names=["label", "features"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """A field fitted on about `fit_rows` whole toxic texts and CLEAN times as many clean ones.

    docs: doc_id, text. labels: doc_id and `label`, 0 or 1. `learn` is a
    condition on doc_id that admits both. An id labelled twice has its higher
    label, one with several texts the least of them; null ids, labels and texts
    are left out. The bounded sample is taken by a hash of the id among the
    labels, so only its few ids meet the texts, whose features are worked out on
    the executors and fitted on the driver. Without toxic rows every score is
    that of a clean text.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(learn).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = written(known, "labels")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    wanted = {1: fit_rows, 0: CLEAN * fit_rows}
    share = F.when(F.col("label") == 1, min(1.0, wanted[1] / max(1, sizes.get(1, 0)))).otherwise(min(1.0, wanted[0] / max(1, sizes.get(0, 0))))
    chance = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)) / 1e6
    # as many ids as the parameter says, whatever the tables hold
    sample = written(known.where(chance < share), "toxicity-ids", sum(wanted.values()))
    texts = docs.where("text is not null").where(learn).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    taken = written(texts.mapInArrow(_tokens_of, "label int, features binary"), "toxicity-sample").toArrow()
    classes = taken.column("label").to_numpy().astype(np.int64)
    features = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, KINDS) for x in taken.column("features")]
    return _train(features, classes, sizes)


def _in_parts(weights: np.ndarray, features: np.ndarray, counts: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """`marginals` of many rows, PART_TOKENS tokens or one row at a time, so that memory stays small."""
    out = np.empty(len(features), np.float32)
    at = np.concatenate(([0], np.cumsum(counts)))
    for first, end in slices(at, PART_TOKENS):
        a, b = at[first], at[end]
        out[a:b] = marginals(_emission(weights, features[a:b]), counts[first:end], transition)
    return out


def _slopes(weights: np.ndarray, features: np.ndarray, counts: np.ndarray, transition: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the log-likelihood of the token labels `target` (0 or 1), by weight and by transition into the toxic state.

    Observed less expected features, and observed less expected pairs of
    neighbours; rows of `counts` tokens are sequences. Worked out in parts, as `_in_parts`.
    """
    slope, pairs = np.zeros(len(weights)), np.zeros(2)
    at = np.concatenate(([0], np.cumsum(counts)))
    for first, end in slices(at, PART_TOKENS):
        a, b = at[first], at[end]
        own = target[a:b].astype(np.float64)
        before = np.concatenate(([0.0], own[:-1]))
        begins = at[first:end][counts[first:end] > 0] - a
        before[begins] = 0
        expected = pair_marginals(_emission(weights, features[a:b]), counts[first:end], transition)
        pairs += [((1 - before) * own).sum(), (before * own).sum()] - expected.sum(axis=0)
        error = own - expected.sum(axis=1)
        for k in range(KINDS):
            slope += np.bincount(features[a:b, k], weights=error, minlength=len(weights))
    return slope, np.array([[0.0, pairs[0]], [0.0, pairs[1]]])


def _train(docs: list[np.ndarray], labels: np.ndarray, sizes: dict[int, int]) -> Model:
    total = KINDS << BITS
    if not (labels == 1).any():
        return Model(np.zeros(total, np.float32), np.zeros((2, 2)), np.array([-20.0, 0, 0, 0]))
    seen = np.zeros((2, total))
    for x, y in zip(docs, labels, strict=True):
        seen[y, np.unique(x)] += 1
    of_class = np.array([[(labels == 0).sum()], [(labels == 1).sum()]], np.float64)
    rate, common = seen / np.maximum(1, of_class), seen.sum(axis=0) / len(labels)
    with np.errstate(divide="ignore", invalid="ignore"):
        sure = np.where(seen > 0, seen * np.log(rate / common), 0).sum(axis=0)
    marks = (rate[1] > ODDS * rate[0]) & (sure > SURE)
    sizes_of = np.array([len(x) for x in docs])
    features = np.concatenate(docs)
    del docs
    pieces = -(-sizes_of // SEQUENCE)
    counts = np.full(int(pieces.sum()), SEQUENCE)
    counts[np.cumsum(pieces)[sizes_of > 0] - 1] = (sizes_of - (pieces - 1) * SEQUENCE)[sizes_of > 0]
    target = (np.repeat(labels == 1, sizes_of) & marks[features].any(axis=1)).astype(np.float32)
    weights, transition = np.zeros(total), np.zeros((2, 2))
    pull, pull_t = np.full(total, 1e-6), np.full((2, 2), 1e-6)
    bias = np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6))
    transition[:, 1] = bias
    for _ in range(ROUNDS):
        slope, slope_t = _slopes(weights, features, counts, transition, target)
        slope -= 1e-2 * weights
        pull += slope**2
        weights += 0.5 * slope / np.sqrt(pull)
        pull_t += slope_t**2
        transition += 0.2 * slope_t / np.sqrt(pull_t)
    weights = weights.astype(np.float32)
    inputs = _sums(_in_parts(weights, features, sizes_of, transition), sizes_of)
    weight = np.where(labels == 1, sizes.get(1, 1) / max(1, (labels == 1).sum()), sizes.get(0, 1) / max(1, (labels == 0).sum()))
    link = np.zeros(4)
    for _ in range(40):  # Newton steps of a ridge logistic regression; classes weigh as in all rows
        p = 1 / (1 + np.exp(-np.clip(inputs @ link, -30, 30)))
        ridge = 0.1 * np.array([0.01, 1, 1, 1])
        slope = inputs.T @ (weight * (labels - p)) - ridge * link
        bend = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + np.diag(ridge + 1e-6)
        link = link + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return Model(weights, transition, link)


def _spans(data: np.ndarray, toxic: np.ndarray, starts: np.ndarray, ends: np.ndarray, origin: int, least: float) -> list[dict]:
    """Runs of toxic tokens as character offsets, with their highest marginal."""
    spans: list[dict] = []
    hot = np.flatnonzero(toxic >= least)
    if not len(hot):
        return spans
    place = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
        spans.append({"start": int(place[starts[run[0]] - origin]), "end": int(place[ends[run[-1]] - origin]), "marginal": float(toxic[run].max())})
    return spans


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])


def _score(model: Model, least: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [c for c in batch.schema.names if c != "__text"]
            data, offsets = text_column(batch.column("__text"))
            for first, end in slices(offsets, 4 << 20):
                part, at = data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
                features, counts, starts, ends = _features(part, at)
                toxic = marginals(_emission(model.weights, features), counts, model.transition)
                value = 1 / (1 + np.exp(-np.clip(_sums(toxic, counts) @ model.link, -30, 30)))
                stops = np.cumsum(counts)
                spans = [_spans(part[at[i] : at[i + 1]], toxic[e - c : e], starts[e - c : e], ends[e - c : e], int(at[i]), least) for i, (e, c) in enumerate(zip(stops, counts, strict=True))]
                own = batch.slice(first, end - first)
                yield pa.record_batch([*[own.column(c) for c in keep], pa.array(value), pa.array(spans, pa.list_(_SPAN))], names=[*keep, "score", "spans"])

    return score


def score_toxicity(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """The `keep` columns of every row with score (0 to 1) and spans (start, end, marginal) of its whole text.

    Spans are runs of tokens with a marginal of `least` or more, as character
    offsets. Null and empty texts have the score of a text without tokens and no
    spans. `keep` must not hold `score` or `spans`; other columns are not read.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*keep, F.col(text_column).alias("__text"))
    return rows.mapInArrow(_score(model, least), with_fields(rows, keep, "score double, spans array<struct<start:bigint,end:bigint,marginal:double>>"))
