"""Hashes of words and word shingles of a slice of texts, computed on whole byte buffers."""

from __future__ import annotations

import numpy as np

SHINGLE = 5

_random = np.random.default_rng(20240917)
#: A random odd 64-bit value for each byte; white space counts nothing.
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n > 1 << 24:
            return known[:n]
        _powers[base] = known
    return known[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word, the number of words of each row, and the words' first and end bytes.

    Words are runs of bytes other than white space (0x20, 0x09 to 0x0D), with
    A-Z lower-cased. Equal words have equal hashes in every task and run.
    """
    rows = len(offsets) - 1
    none = np.zeros(0, np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64), none, none
    lower = _LOWER[data]
    word = ~_SPACE[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    inner = offsets[1:-1]
    before[inner[inner < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64), none, none
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[inner[(inner > 0)] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    terms = _BYTE[lower]
    terms *= _power(_BASE, len(data))
    hashes = np.add.reduceat(terms, starts)
    hashes *= _power(_INVERSE, len(data))[starts]
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(hashes), counts, starts, ends


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words, without regard to rows."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _PLACE[0]
    for k in range(1, size):
        total += words[k : k + n] * _PLACE[k]
    return mix(total)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes row after row, repeats included, and the number of them in each row.

    A row of fewer words than `size` has its whole sequence as one shingle; a
    row without words has none.
    """
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.empty(int(made.sum()), np.uint64)
    ends = np.cumsum(made)
    windows = window_hashes(words, size)
    full = counts >= size
    if full.any():
        keep = np.zeros(len(words) + 1, np.int64)
        np.add.at(keep, starts[full], 1)
        np.add.at(keep, starts[full] + made[full], -1)
        place = np.zeros(len(out) + 1, np.int64)
        np.add.at(place, (ends - made)[full], 1)
        np.add.at(place, ends[full], -1)
        out[np.cumsum(place[:-1]) > 0] = windows[np.cumsum(keep[:-1])[: len(windows)] > 0]
    for row in np.flatnonzero((counts > 0) & ~full):
        own = words[starts[row] : starts[row] + counts[row]]
        total = np.uint64(0x51ED270B9F3A1) + np.uint64(counts[row])
        with np.errstate(over="ignore"):
            for k, w in enumerate(own):
                total = total + w * _PLACE[k + 32]
        out[ends[row] - 1] = mix(np.array([total], np.uint64))[0]
    return out, made


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def distinct_counts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many distinct values each row of `counts` values has."""
    out = counts.astype(np.int64)
    if not len(values):
        return out
    # one sort for all rows: the row above the values' high bits. Only rows that seem to repeat one are counted by whole values.
    bits = np.uint64(max(1, len(counts).bit_length()))
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    marked = np.sort(row << (np.uint64(64) - bits) | values >> bits)
    repeats = np.unique(marked[1:][marked[1:] == marked[:-1]] >> (np.uint64(64) - bits))
    ends = np.cumsum(counts)
    for r in repeats.astype(np.int64):
        out[r] = len(distinct_sorted(values[ends[r] - counts[r] : ends[r]]))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


#: Bytes of words for letter tokens: ASCII letters and digits, and all bytes of other characters.
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = True
_TOKEN[128:] = True


#: Code points of scripts that are written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han),
#: and of punctuation and spaces beyond ASCII.
SPACELESS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
MARKS = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def _among(points: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    edges = np.array([x for first, last in ranges for x in (first, last + 1)])
    return np.searchsorted(edges, points, side="right") % 2 == 1


def beyond_ascii(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 bytes: which belong to MARKS; and first byte and end of each character of the SPACELESS scripts."""
    mark = np.zeros(len(data), bool)
    starts, ends = [], []
    for least, most, size in ((0xC2, 0xC2, 2), (0xE0, 0xEF, 3), (0xF0, 0xF4, 4)):
        at = np.flatnonzero((data >= least) & (data <= most))
        point = data[at].astype(np.int64) & (0xFF >> size + 1)
        for k in range(1, size):
            point = point << 6 | data[at + k] & 0x3F
        marks, alone = at[_among(point, MARKS)], at[_among(point, SPACELESS)]
        for k in range(size):
            mark[marks + k] = True
        starts.append(alone)
        ends.append(alone + size)
    return mark, np.concatenate(starts), np.concatenate(ends)


def letter_tokens(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...], suffix: int, scripts: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of runs of letters, one column each for the run, its first bytes and its last; as `word_hashes` otherwise.

    With `scripts`, MARKS part runs and a character of the SPACELESS scripts is a run of its own.
    """
    width = 2 + len(prefixes)
    none = np.zeros(0, np.int64)
    word = _TOKEN[data]
    parted = none
    if scripts:
        mark, first, end = beyond_ascii(data)
        word = word & ~mark
        parted = np.concatenate((first, end[end < len(data)]))
    before = np.empty_like(word)
    if len(word):
        before[0], before[1:] = False, word[:-1]
        inner = offsets[1:-1]
        before[inner[inner < len(data)]] = False
        before[parted] = False
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return np.zeros((0, width), np.uint64), np.zeros(len(offsets) - 1, np.int64), none, none
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[inner[inner > 0] - 1] = False
    after[parted[parted > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _power(_BASE, len(data)), out=sums[1:])
    back = _power(_INVERSE, len(data))
    out = np.empty((len(starts), width), np.uint64)
    out[:, 0] = mix((sums[ends] - sums[starts]) * back[starts])
    for k, length in enumerate(prefixes, 1):
        out[:, k] = mix((sums[np.minimum(starts + length, ends)] - sums[starts]) * back[starts])
    last = np.maximum(ends - suffix, starts)
    out[:, -1] = mix((sums[ends] - sums[last]) * back[last])
    return out, np.diff(np.searchsorted(starts, offsets)), starts, ends


def sequence_keys(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128-bit keys (rows x 2 values) of word sequences: equal for equal ones, different by all odds for others."""
    rows = np.flatnonzero(counts)
    out = np.zeros((len(counts), 2), np.uint64)
    if not len(rows):
        return out
    starts = (np.cumsum(counts) - counts)[rows]
    place = np.arange(len(words)) - np.repeat(starts, counts[rows])
    for k, (base, salt) in enumerate(((0xD6E8FEB86659FD93, 0x2545F4914F6CDD1D), (0xA0761D6478BD642F, 0x9E6C63D0876A9A47))):
        terms = mix(words + np.uint64(salt)) * _power(base, int(place.max()) + 1)[place]
        out[rows, k] = mix(np.add.reduceat(terms, starts) + counts[rows].astype(np.uint64) * np.uint64(salt | 1))
    return out


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows, each line's row, and its number in the row; a row has one line more than line ends."""
    after = np.flatnonzero(data == 10) + 1
    # line ends belong to the line before; rows without text have one empty line
    row = np.searchsorted(offsets, after - 1, side="right") - 1
    rows = np.concatenate((np.arange(len(offsets) - 1), row))
    starts = np.concatenate((offsets[:-1], after))
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    first = np.searchsorted(rows, np.arange(len(offsets) - 1))
    return np.concatenate((starts, [len(data)])), rows, np.arange(len(rows)) - first[rows]
