"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. Hashes are of the word with A-Z in lower case: a polynomial in a fixed odd base over a
fixed random table of byte values, modulo 2**64, and a bijective mixing of that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240607)
VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WINDOW = 1 << 16
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the 0th up to the n-th power, and the inverses."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, WINDOW + 1)
        _powers = tuple(
            np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64))))
            for b in (BASE, INVERSE)
        )
    return _powers


@dataclass
class Words:
    hash: np.ndarray   # uint64
    row: np.ndarray    # which text
    first: np.ndarray  # byte offsets into the buffer of all texts
    end: np.ndarray


@dataclass
class Texts:
    data: np.ndarray    # uint8, all texts one after the other
    offset: np.ndarray  # int64, one more than texts

    def __len__(self) -> int:
        return len(self.offset) - 1


def texts_of(column: pa.Array) -> Texts:
    """The buffer of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offset = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offset[0] : offset[-1]], offset - offset[0])


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int):
    """Slices of a batch of about that much text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    size = np.diff(texts_of(batch.column(text)).offset)
    group = (np.cumsum(size) - size) // most_bytes
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=group[-1] + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(int(a), int(b - a))


def words_of(texts: Texts) -> Words:
    """All words of all texts, in order."""
    row, first, end = spans_of(texts)
    return Words(_hashed(texts.data, first, end), row, first, end)


def spans_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of every word."""
    data, offset = texts.data, texts.offset
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    # As `~BLANK[data]`, in a tenth of the time.
    inside = (data != 0x20) & (data - np.uint8(0x09) > np.uint8(0x04))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    begins = offset[:-1][np.diff(offset) > 0]
    opens[begins] = inside[begins]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    first, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.arange(len(texts)).repeat(np.diff(np.searchsorted(first, offset)))
    return row, first, end


def _hashed(
    data: np.ndarray, first: np.ndarray, end: np.ndarray, fold: np.ndarray = LOWER
) -> np.ndarray:
    """Windows of words that span about WINDOW bytes, so that memory doesn't follow the text."""
    out, a, value = np.zeros(len(first), np.uint64), 0, VALUE[fold]
    while a < len(first):
        base = first[a]
        b = max(a + 1, int(np.searchsorted(end, base + WINDOW, side="right")))
        stop = end[b - 1]
        up, down = powers(int(stop - base))
        total = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(value[data[base:stop]] * up[: stop - base], out=total[1:])
        f, e = first[a:b] - base, end[a:b] - base
        out[a:b] = mixed((total[e] - total[f]) * down[f] + (e - f).astype(np.uint64))
        a = b
    return out


def lines_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, start and end of every line; an empty text has one empty line."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    first = np.sort(np.concatenate((texts.offset[:-1], breaks + 1)), kind="stable")
    row = np.arange(len(texts)).repeat(
        1 + np.diff(np.searchsorted(breaks, texts.offset))
    )
    end = np.append(first[1:], texts.offset[-1])
    same = np.append(row[1:] == row[:-1], False)
    end = np.where(same, end - 1, texts.offset[1:][row])
    value = np.zeros(len(first), np.uint64)
    full = end > first
    value[full] = _hashed(texts.data, first[full], end[full], np.arange(256, dtype=np.uint8))
    return value, row, first, end


def counts_in(mask: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many bytes of each span the mask holds."""
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[end] - total[first]


def runs_of(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every run of ``k`` consecutive words within one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * BASE + mixed(hashes[i : i + n] + np.uint64(i))
    start = np.flatnonzero(row[:n] == row[k - 1 :])
    return mixed(total[start]), start


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, by row and then value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def shingles_of(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle of ``k`` words); a text of fewer words has one, its sequence."""
    words = words_of(texts)
    value, start = runs_of(words.hash, words.row, k)
    count = np.bincount(words.row, minlength=len(texts))
    row = words.row[start]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        opens = np.concatenate(([0], np.cumsum(count)))
        total = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            held = count[few] > i
            at = np.minimum(opens[few] + i, len(words.hash) - 1)
            total = np.where(held, total * BASE + mixed(words.hash[at] + np.uint64(i + 17 * k)), total)
        value = np.concatenate((value, mixed(total + count[few].astype(np.uint64))))
        row = np.concatenate((row, few))
    return distinct(row, value)
