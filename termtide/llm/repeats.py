"""Runs: stretches of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q, at least `LEAST` words and
`TIMES` periods long, that no neighbouring word extends.

Every run has a Lyndon root: a word that is smaller than all its proper suffixes, in one of the
two orders of the alphabet, and the longest such word where it begins. It ends where the next
smaller suffix (in the other order: the next greater one) begins, so each place gives two
candidates. Each is extended in both directions by the longest common extension (LCE) of two
places: the depth of the lowest common ancestor of two leaves in Ukkonen's suffix tree of the
words, and in that of their reversal, found in constant time as a minimum over the Euler tour.

Trees are built for the stretches of a text where a run can lie: in a run, every window of
`WINDOW` words occurs once more one period on or back, so a run lies within one stretch of
consecutive windows that the text holds twice. What the windows leave out has no run, and within a
stretch all runs are found. Memory follows the longest such stretch of one text, not the batch.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.textscan import mixed, pieces, runs_of, texts_of, words_of

LEAST, TIMES = 24, 3
#: max(LEAST, TIMES * q) >= 2 * q + WINDOW for every q; tests hold it.
WINDOW = 8
PIECE = 1 << 20


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's tree of numbers whose last one occurs nowhere else.

    First and end place of the edge to each node (0 is the root), and the child by
    node * base + first number of its edge; and base.
    """
    n, base = len(s), max(s) + 1
    first, end, link, child = [0], [0], [0], {}
    node = edge = length = open_ = 0
    for i, c in enumerate(s):
        open_ += 1
        inner = 0
        while open_:
            if not length:
                edge = i
            key = node * base + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(first)
                first.append(i)
                end.append(n)
                link.append(0)
                if inner:
                    link[inner] = node
                    inner = 0
            else:
                span = end[below] - first[below]
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                at = first[below] + length
                if s[at] == c:
                    if inner:
                        link[inner] = node
                    length += 1
                    break
                middle = len(first)
                child[key] = middle
                first += (first[below], i)
                end += (at, n)
                link += (0, 0)
                first[below] = at
                child[middle * base + s[at]] = below
                child[middle * base + c] = middle + 1
                if inner:
                    link[inner] = middle
                inner = middle
            open_ -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_ + 1
    return first, end, child, base


class Extensions:
    """Longest common extensions of places of ``s``, whose last number occurs nowhere else and
    is the least; ``rank`` is the order of its suffixes."""

    def __init__(self, s: list[int]):
        n = len(s)
        first, end, child, base = suffix_tree(s)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        # Keys are by parent, then by the edge's first number: children in the words' order.
        order = np.argsort(keys)
        kids = nodes[order].tolist()
        opens = np.searchsorted(keys[order] // base, np.arange(len(first) + 1)).tolist()
        edge = (np.array(end) - np.array(first)).tolist()
        tour, place, depth, upto = [], [0] * n, [0] * len(first), opens[:-1]
        upto, path = list(upto), [0]
        while path:
            v = path[-1]
            tour.append(depth[v])
            at = upto[v]
            if at == opens[v + 1]:
                if opens[v] == at:
                    place[n - depth[v]] = len(tour) - 1
                path.pop()
                continue
            upto[v] = at + 1
            w = kids[at]
            depth[w] = depth[v] + edge[w]
            path.append(w)
        self.place = np.array(place)
        self.rank = np.empty(n, np.int64)
        self.rank[np.argsort(self.place)] = np.arange(n)
        # Level k holds the least of 2**k depths from each place on.
        self.levels = [np.array(tour, np.int32)]
        step = 1
        while 2 * step <= len(tour):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree from two different places on."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own = level == k
            low = self.levels[k]
            out[own] = np.minimum(low[a[own]], low[b[own] - (1 << k) + 1])
        return out


def _next(rank: list[int]) -> tuple[list[int], list[int]]:
    """Next place with a smaller and with a greater rank; -1: none."""
    less, more = [-1] * len(rank), [-1] * len(rank)
    falling, rising = [], []
    for j, r in enumerate(rank):
        while rising and rank[rising[-1]] > r:
            less[rising.pop()] = j
        rising.append(j)
        while falling and rank[falling[-1]] < r:
            more[falling.pop()] = j
        falling.append(j)
    return less, more


def runs_in(s: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs of numbers over 0, by start, then period."""
    m = len(s)
    if m < 2:
        return []
    on, back = Extensions([*s, 0]), Extensions([*s[::-1], 0])
    i = np.tile(np.arange(m), 2)
    j = np.array([x for some in _next(on.rank.tolist()) for x in some[:m]])
    i, j = i[j >= 0], j[j >= 0]
    start, end, period = i - back.of(m - i, m - j), j + on.of(i, j), j - i
    kept = (end - start >= times * period) & (end - start >= least) & (end - start >= 2 * period)
    found = set(zip(start[kept].tolist(), (end - start)[kept].tolist(), period[kept].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
    """First and end word of each stretch whose windows all occur twice in the same text."""
    value, start = runs_of(hashes, row, WINDOW)
    if not len(start):
        return []
    key = mixed(value ^ mixed(row[start].astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    held = start[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
    text = row[held]
    opens = np.flatnonzero(np.concatenate(([True], (np.diff(held) > 1) | (text[1:] != text[:-1]))))
    last = np.append(opens[1:], len(held)) - 1
    found = zip(held[opens].tolist(), (held[last] + WINDOW).tolist())
    return [(a, b) for a, b in found if b - a >= LEAST]


def planted_places(doc: int | None, n: int) -> np.ndarray | None:
    """The rewriting that the query asks for: in a tenth of the texts, by the id's crc32, the
    words from some place on repeat with a period. Which word comes at each place; None: as it is."""
    if doc is None or not n:
        return None
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % period
    return at


def _piece(piece: pa.RecordBatch, rewrite) -> tuple[np.ndarray, list, list]:
    """Words, runs and collapsed text of each row."""
    texts = texts_of(piece.column("text"))
    words = words_of(texts)
    count = np.bincount(words.row, minlength=len(texts))
    opens = np.concatenate(([0], np.cumsum(count))).tolist()
    at = np.arange(len(words.hash))
    moved = set()
    if rewrite:
        for i, doc in enumerate(piece.column("doc").to_pylist()):
            places = rewrite(doc, opens[i + 1] - opens[i])
            if places is not None:
                at[opens[i] : opens[i + 1]] = opens[i] + places
                moved.add(i)
    by_row: dict[int, list] = {}
    for a, b in stretches(words.hash[at] if moved else words.hash, words.row):
        by_row.setdefault(int(words.row[a]), []).append((a, b))
    data, offset = texts.data.tobytes(), texts.offset.tolist()
    runs, collapsed = [], []
    for i in range(len(texts)):
        # bytes.split() parts at the same six blanks.
        own = data[offset[i] : offset[i + 1]].split()
        if i in moved:
            own = [own[k] for k in (at[opens[i] : opens[i + 1]] - opens[i]).tolist()]
        found = []
        for a, b in by_row.get(i, ()):
            number: dict[bytes, int] = {}
            a, b = a - opens[i], b - opens[i]
            s = [number.setdefault(w, len(number) + 1) for w in own[a:b]]
            found += [(a + start, length, period) for start, length, period in runs_in(s)]
        if found:
            # How many runs hold each word after their first period.
            cover = np.zeros(len(own) + 1, np.int64)
            for start, length, period in found:
                cover[start + period] += 1
                cover[start + length] -= 1
            own = [w for w, c in zip(own, np.cumsum(cover[:-1]).tolist()) if not c]
        runs.append(sorted(found, key=lambda r: (r[0], r[2])))
        collapsed.append(b" ".join(own))
    return count, runs, collapsed


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """Per row: doc (long), n_words, runs (array of start, length, period, by start, then period)
    and collapsed, the text's words without those that a run repeats, joined by single blanks.

    Words are equal if their bytes are. A null, empty or blank text has no words and no runs, and
    collapses to an empty text. Repeated rows and null ids each give a row. An empty table gives no rows. Other
    columns are not read. ``rewrite``, of id and number of words, may put words in other places first.
    """
    run = pa.struct([pa.field(c, pa.int64()) for c in ("start", "length", "period")])

    def found(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                count, runs, collapsed = _piece(piece, rewrite)
                sizes = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
                flat = np.array([r for some in runs for r in some], np.int64).reshape(-1, 3)
                items = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], fields=list(run))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc"), pa.array(count.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(sizes), items),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    fields = "doc bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(found, fields)


def digests(runs: DataFrame) -> DataFrame:
    """Per row: its runs' number, the one with the greatest exact length over period (ties: least
    start, then period), and digests of all runs and of the collapsed text."""
    best = F.element_at(F.expr(
        """array_sort(runs, (a, b) -> case
             when a.length * b.period > b.length * a.period then -1
             when a.length * b.period < b.length * a.period then 1
             when a.start < b.start then -1 when a.start > b.start then 1
             when a.period < b.period then -1 when a.period > b.period then 1 else 0 end)"""
    ), 1)
    shown = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    rows = runs.withColumn("best", F.when(F.size("runs") > 0, best))
    return rows.select(
        "doc", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
