"""Secrets in texts: known shapes, and stretches whose letters are as mixed as a random key's.

The stretches are found by the Shannon entropy of sliding windows over runs of
one character class; the counts behind it change by one character in and one out
as a window moves. An allow-list takes out what is random by nature but no
secret, and listings of characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.llm.tables import small_batches, with_fields

# The known shapes, in the order that sorts spans of one start.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 32
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Runs of some characters, and the bits a character from which a window of them counts as random.

    A window also needs a digit and a letter, which long words do not have.
    """

    kind: str
    characters: str
    window: int
    bits: float

    @property
    def runs(self) -> re.Pattern[str]:
        return re.compile(f"[{self.characters}]{{{self.window},}}")


#: A random window of 24 hexadecimal digits has 3.5 bits a character, one of 20 base64 characters 4.1.
CLASSES = (
    CharacterClass("entropy_hex", "0-9a-fA-F", 24, 3.0),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.9),
)
#: Random by nature but no secrets: a run inside a match of one of these is passed over. Each takes time in proportion to the text.
ALLOWED = (
    r"\b[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\b",  # UUID
    r"https?://[^\s\"'<>]+",
    r"\b(?:sha(?:1|224|256|384|512)|md5|commit|revision)[-:= ]{1,2}[A-Za-z0-9+/=]+",  # digests that say so
    r"data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+",
)
#: A stretch of random windows that meets one of these within its run is a listing of characters.
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789abcdef")
_SEQUENCE = re.compile("|".join(SEQUENCES), re.IGNORECASE | re.ASCII)
_REACH = max(map(len, SEQUENCES)) - 1
#: Characters that are looked at together; a longer run is taken in pieces that overlap by a window.
PIECE = 1 << 18

SPANS = "spans array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
#: n * log2(n) in units of 2**-32: sums of them are exact, so a window's entropy does not depend on those before it.
_UNIT = 1 << 32
_TERMS = np.array([0, *(round(n * float(np.log2(n)) * _UNIT) for n in range(1, 257))], np.int64)


def known_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the known shapes, leftmost and without overlap for each shape, too short ones dropped."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX_RUNS.finditer(text)]
    return found


#: The same matches as HEX's of HEX_LEAST or more, since runs are taken whole; found without stopping at each short one.
HEX_RUNS = re.compile(f"{HEX.pattern[:-1]}{{{HEX_LEAST},}}")


def random_windows(codes: np.ndarray, starts: np.ndarray, window: int, bits: float) -> np.ndarray:
    """First places of the windows that are random enough, over strings that lie one after another in `codes`.

    `starts` are the strings' places and the end of the last. A window lies
    within one string, holds a digit and a letter, and has at least `bits` of
    entropy a character.
    """
    n = len(codes)
    if n < window:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    place = np.arange(n)
    # places of equal characters of a string next to each other, in order
    keys = (owner * 256 + codes) * (n + 1) + place
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    rank = np.empty(n, np.int64)
    rank[order] = place
    first = keys - keys % (n + 1)
    base = np.empty(n, np.int64)
    base[order] = first
    # the count of a place's character among the last `window` places, and among the next
    entering = rank - np.searchsorted(keys, base + np.maximum(place - window + 1, 0)) + 1
    leaving = np.searchsorted(keys, base + np.minimum(place + window, n)) - rank
    change = _TERMS[entering] - _TERMS[entering - 1]
    out = np.flatnonzero(place + window < starts[owner + 1])
    change[out + window] -= (_TERMS[leaving] - _TERMS[leaving - 1])[out]
    total = np.concatenate(([0], np.cumsum(change)))
    whole = np.flatnonzero(place + window <= starts[owner + 1])
    sums = total[whole + window] - total[starts[owner[whole]]]
    digit = (codes >= 48) & (codes <= 57)
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    mixed = np.ones(len(whole), bool)
    for kind in (digit, letter):
        count = np.concatenate(([0], np.cumsum(kind)))
        mixed &= count[whole + window] > count[whole]
    most = round((window * float(np.log2(window)) - window * bits) * _UNIT) + window  # rounded terms may not tip a tie
    return whole[mixed & (sums <= most)]


def _pieces(runs: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs (text, start, end) in lots of about PIECE characters; longer runs in pieces that share all but one of a window's places."""
    lot, size = [], 0
    for text, start, end in runs:
        while True:
            stop = min(end, start + PIECE)
            lot.append((text, start, stop))
            size += stop - start
            if size >= PIECE:
                yield lot
                lot, size = [], 0
            if stop == end:
                break
            start = stop - window + 1
    if lot:
        yield lot


def entropy_spans(texts: list[str], kinds: tuple[CharacterClass, ...] = CLASSES) -> list[list[tuple[str, int, int, int, int]]]:
    """For each text: kind, start and end of each stretch of random windows, and the run around it."""
    out: list[list[tuple[str, int, int, int, int]]] = [[] for _ in texts]
    for kind in kinds:
        pattern = kind.runs
        runs = [(t, *m.span()) for t, text in enumerate(texts) for m in pattern.finditer(text)]
        found: list[tuple[int, int]] = []
        for lot in _pieces(runs, kind.window):
            codes = np.frombuffer("".join(texts[t][a:b] for t, a, b in lot).encode("ascii"), np.uint8).astype(np.int64)
            starts = np.concatenate(([0], np.cumsum([b - a for _, a, b in lot])))
            hits = random_windows(codes, starts, kind.window, kind.bits)
            of = np.searchsorted(starts, hits, side="right") - 1
            found += [(lot[k][0], lot[k][1] + int(h - starts[k])) for k, h in zip(of.tolist(), hits.tolist(), strict=True)]
        run = 0
        for text, start in found:
            while not (runs[run][0] == text and runs[run][1] <= start < runs[run][2]):
                run += 1
            spans = out[text]
            if spans and spans[-1][0] == kind.kind and spans[-1][2] >= start and spans[-1][3] == runs[run][1]:
                spans[-1] = (*spans[-1][:2], start + kind.window, *spans[-1][3:])
            else:
                spans.append((kind.kind, start, start + kind.window, *runs[run][1:]))
    return out


def spans_of(texts: list[str], kinds: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> list[list[tuple[str, int, int]]]:
    """All spans of each text by start, then kind in the order listed, then end."""
    order = {kind: k for k, kind in enumerate((*BASE_KINDS, *(each.kind for each in kinds)))}
    patterns = [re.compile(each) for each in allowed]
    out = []
    for text, random in zip(texts, entropy_spans(texts, kinds), strict=True):
        spans = known_spans(text)
        if random:
            fine = [m.span() for pattern in patterns for m in pattern.finditer(text)]
            fine = _merged(fine)
            ends = np.array([end for _, end in fine], np.int64)
            for kind, start, end, run, run_end in random:
                if _SEQUENCE.search(text, max(run, start - _REACH), min(run_end, end + _REACH)):
                    continue
                at = int(np.searchsorted(ends, run_end)) if len(fine) else 0
                if at == len(fine) or fine[at][0] > run:
                    spans.append((kind, start, end))
        out.append(sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by start, those within others left out: starts and ends both rise."""
    out: list[tuple[int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or span[1] > out[-1][1]:
            out.append(span)
    return out


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    kinds: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """The `keep` columns (doc_id) of each row, and its spans: kind, start and end in code points, end exclusive.

    Spans of the known shapes (`BASE_KINDS`) are always there; `allowed`, regular
    expressions, only takes out those of the entropy `kinds`. Rows are judged one
    by one, so nothing is shuffled. A null or empty text has no spans; repeated
    rows have the same.
    """
    keep = ["doc_id"] if keep is None else keep
    if "spans" in keep:
        raise ValueError("a kept column may not be named spans")
    small_batches(docs.sparkSession)
    schema = with_fields(docs, keep, SPANS)
    # columns go by place: a kept one may be the text itself
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text), F.lit("")).alias("text" if "text" not in keep else "the text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in each] for each in spans_of(texts, kinds, allowed)]
            column = pa.array(spans, pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=schema.names)

    return rows.mapInArrow(found, StructType(schema.fields))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
