"""Katz backoff language model: trained on some documents, scoring all.

Tokens are 64-bit hashes of words, A-Z in lower case, and one end per text. The model is a bigram
model: Good-Turing discounted counts, and for what a history has not been followed by, the
unigram probability times the history's backoff weight, exactly normalised.

    P(w | h) = d(c(h, w)) c(h, w) / (c(h) + 1)      if h was followed by w
             = weight(h) P(w)                       else; weight 1 if h was not seen
    P(w)     = d(c(w)) c(w) / (N + 1)               if w was seen; what is left is one unknown word
    weight(h) = (1 - sum of P(w | h)) / (1 - sum of P(w)) over the w that followed h

Without the one event more per history, one whose followers all came more than five times, which
are not discounted, would leave nothing for other words.

Data flow: a scan cuts the texts into chunks, and sends each chunk's bigrams to partitions by
their second word, as packed arrays with one entry per distinct bigram of the chunk and, for each
document that has it, a short document number and how often; a blob lists the documents it has, so what is sent follows the
tokens, however many partitions there are. There lie all counts of a word; one job over them gathers the
counts of counts, a second one, over the same shuffle files, scores. What only a history knows
goes on to partitions by history: (history, sums over its followers) and the few occurrences of
bigrams that were never seen; what documents add up to goes to partitions by chunk, as do their ids, once. Words so frequent that they would fill a partition are dealt out by
both words; their total comes with the counts of counts. Bigrams so frequent themselves are dealt
out by chunk and document as well; their totals come the same way, and every partition by history
gets them from the model. The lists of both only steer the rows.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.tables import give_back
from termtide.llm.textscan import mixed, pieces, texts_of, words_of

END, START = np.uint64(1), np.uint64(2)
#: Counts up to this are discounted.
K = 5
PIECE = 1 << 20
CHUNK_TOKENS = 1_500_000
PART_BYTES = 16 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, like bytes together."""
    parts = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        parts.append((x.dtype.str, len(x), x.view(np.uint8).reshape(len(x), -1).T.tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, data in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        rows = np.frombuffer(data, np.uint8).reshape(-1, n).T
        out.append(np.ascontiguousarray(rows).view(kind).ravel())
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def held_out(ids: list, folds: int = 7, fold: int = 2) -> np.ndarray:
    """Is crc32 of the id as text, modulo ``folds``, ``fold``? A null id is not held out."""
    return np.array([i is not None and zlib.crc32(str(i).encode()) % folds == fold for i in ids], bool)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, history and text of every token, the ends included."""
    words, n = words_of(texts_of(column)), len(column)
    count = np.bincount(words.row, minlength=n) + 1
    last = np.cumsum(count) - 1
    token = np.full(int(count.sum()), END, np.uint64)
    token[np.arange(len(words.hash)) + words.row] = words.hash
    history = np.empty_like(token)
    history[1:] = token[:-1]
    history[last - count + 1] = START
    return token, history, np.arange(n).repeat(count)


@dataclass
class Hot:
    """Bigrams so frequent that their documents are dealt out, in order of a hash of both words."""

    key: np.ndarray
    word: np.ndarray
    history: np.ndarray

    @staticmethod
    def of(word: np.ndarray, history: np.ndarray) -> Hot:
        key = pair_key(word, history)
        _, at = np.unique(key, return_index=True)
        return Hot(key[at], word[at], history[at])

    def find(self, word: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bigrams are hot, and the place of each of those."""
        hot = among(word, np.unique(self.word)) & among(history, np.unique(self.history))
        some = np.flatnonzero(hot)
        if not len(some):
            return hot, some
        word, history = word[some], history[some]
        at = np.minimum(np.searchsorted(self.key, pair_key(word, history)), len(self.key) - 1)
        hot[some] = same = (self.word[at] == word) & (self.history[at] == history)
        return hot, at[same]


def pair_key(word: np.ndarray, history: np.ndarray) -> np.ndarray:
    return mixed(word ^ mixed(history))


def frequent(texts: DataFrame, parts: int) -> tuple[np.ndarray, Hot]:
    """Words that are more than a fifth of a partition's share of all tokens, and bigrams that are
    more than half of it; a few may be less.

    Every piece of text reports words and bigrams that are a sixteenth of that share in it, so one
    that is missing has less than that sixteenth anywhere it went unreported.
    """
    none = np.zeros(0, np.uint64)
    if parts == 1:
        return none, Hot(none, none, none)

    def counted(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                token, history, _ = tokens_of(piece.column("text"))
                word, n = np.unique(token, return_counts=True)
                many = n * 16 * parts >= len(token)
                # Both words of such a bigram are as frequent.
                names = np.append(word[many], START)
                names.sort()
                some = np.flatnonzero(among(token, names) & among(history, names))
                token, history, size = token[some], history[some], len(token)
                _, first, m = np.unique(pair_key(token, history), return_index=True, return_counts=True)
                pairs = m * 16 * parts >= size
                first, m = first[pairs], m[pairs]
                words = np.concatenate((word[many], token[first], np.zeros(1, np.uint64)))
                times = np.concatenate((n[many], m, [0]))
                before = np.concatenate((np.zeros(many.sum(), np.uint64), history[first], np.zeros(1, np.uint64)))
                both = np.arange(len(words)) < many.sum()
                both[-1] = True
                total = np.zeros(len(words), np.int64)
                total[-1] = size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words.view(np.int64)), pa.array(before.view(np.int64), mask=both),
                        pa.array(times), pa.array(total),
                    ],
                    ["word", "history", "n", "total"],
                )

    sums = texts.select("text").mapInArrow(counted, "word bigint, history bigint, n bigint, total bigint")
    sums = sums.groupBy("word", "history").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    sums = sums.persist()
    total = sums.agg(F.sum("total")).first()[0] or 0
    least = F.when(F.col("history").isNull(), F.col("n") * 8 * parts).otherwise(F.col("n") * 2 * parts)
    found = sums.where(least >= total).where("n > 0").select("word", "history").collect()
    sums.unpersist()
    asarray = lambda x: np.array(x, np.int64).view(np.uint64)
    pairs = [r for r in found if r.history is not None]
    return (
        np.unique(asarray([r.word for r in found])),
        Hot.of(asarray([r.word for r in pairs]), asarray([r.history for r in pairs])),
    )


def among(x: np.ndarray, names: np.ndarray) -> np.ndarray:
    if not len(names):
        return np.zeros(len(x), bool)
    return names[np.minimum(np.searchsorted(names, x), len(names) - 1)] == x


def bigram_chunks(batches, parts: int, heavy: np.ndarray, hot: Hot, folds: int, fold: int):
    """(partition, ids?, packed) of chunk after chunk of a task's texts: the bigrams for each
    partition, and, for one of them to pass on, the documents' ids and which are held out."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush():
        ids = [i for part in held for i in part[0]]
        starts = np.cumsum([0, *(len(part[0]) for part in held)])
        token, history = (np.concatenate([part[k] for part in held]) for k in (1, 2))
        text = np.concatenate([part[3] + s for part, s in zip(held, starts)])
        dealt = token.copy()
        many = among(token, heavy)
        dealt[many] ^= mixed(history[many])
        often, _ = hot.find(token, history)
        # A few places for each chunk, so that a hot bigram's share follows the partitions'.
        dealt[often] ^= mixed(np.uint64(task << 32 | number << 4) + (text[often] % 16).astype(np.uint64))
        part = (mixed(dealt) % np.uint64(parts)).astype(np.uint32)
        # Texts come in order, and stay so within a bigram.
        order = np.lexsort((history, token, part))
        del dealt, many, often
        part, token, history, text = part[order], token[order], history[order], text[order]
        new = np.ones(len(part), bool)
        new[1:] = (token[1:] != token[:-1]) | (history[1:] != history[:-1])
        # One entry for each bigram of a document, and how often it has it.
        entry = new.copy()
        entry[1:] |= text[1:] != text[:-1]
        place = np.flatnonzero(entry)
        times = np.diff(place, append=len(part))
        part, token, history, text, new = (x[place] for x in (part, token, history, text, new))
        known = np.array([i is not None for i in ids], bool)
        names = np.array([0 if i is None else i for i in ids], np.int64)
        flags = held_out(ids, folds, fold)
        key = np.array([task, number, len(ids)], np.int64)
        yield hash((task, number)) % parts, True, pack(key, names, known, flags)
        edges = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[p], edges[p + 1]
            at = np.flatnonzero(new[a:b])
            repeats = np.diff(at, append=b - a)
            present, local = np.unique(text[a:b], return_inverse=True)
            yield p, False, pack(
                key, narrow(np.diff(present, prepend=0)), flags[present],
                np.diff(token[a:b][at], prepend=np.uint64(0)), history[a:b][at], narrow(repeats),
                narrow(local), narrow(times[a:b]),
            )

    for batch in batches:
        for piece in pieces(batch, "text", PIECE):
            held.append((piece.column("doc").to_pylist(), *tokens_of(piece.column("text"))))
            size += len(held[-1][1])
            if size >= CHUNK_TOKENS:
                yield from flush()
                number, held, size = number + 1, [], 0
    if held:
        yield from flush()
    held.clear()
    give_back()


@dataclass
class Counts:
    """The bigrams of one partition; per bigram of a document unless said otherwise."""

    chunks: list          # (task, number and documents of the chunk; documents here, held out) per chunk
    doc: np.ndarray       # document, numbered through those of all chunks that are here
    pair: np.ndarray      # which distinct bigram
    times: np.ndarray     # how often the document has it
    word: np.ndarray      # per distinct bigram
    history: np.ndarray   # per distinct bigram
    count: np.ndarray     # per distinct bigram, in training texts
    word_at: np.ndarray   # per distinct bigram: which distinct word
    words: np.ndarray     # per distinct word
    word_count: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum([0, *(len(c[1]) for c in self.chunks)])


def counts_of(blobs) -> Counts | None:
    chunks, token, history, repeats, text, often, base = [], [], [], [], [], [], 0
    for blob in blobs:
        key, present, flags, t, h, r, d, n = unpack(blob)
        chunks.append((tuple(key.tolist()), np.cumsum(present, dtype=np.int64), flags))
        token.append(np.cumsum(t, dtype=np.uint64))
        history.append(h)
        repeats.append(r.astype(np.int64))
        text.append(d.astype(np.int32) + np.int32(base))
        often.append(n)
        base += len(present)
    if not chunks:
        return None
    token, history, repeats, doc, times = map(np.concatenate, (token, history, repeats, text, often))
    del text, often, blob, t, h, r, d, n
    order = np.lexsort((history, token))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(token[order]) != 0) | (np.diff(history[order]) != 0)
    entry_pair = np.empty(len(order), np.int32)
    entry_pair[order] = np.cumsum(new) - 1
    pair = entry_pair.repeat(repeats)
    del entry_pair, repeats
    training = ~np.concatenate([c[2] for c in chunks])
    word, history = token[order][new], history[order][new]
    count = np.bincount(pair, weights=times * training[doc], minlength=len(word)).astype(np.int64)
    first = np.ones(len(word), bool)
    first[1:] = word[1:] != word[:-1]
    word_at = np.cumsum(first) - 1
    word_count = np.bincount(word_at, weights=count).astype(np.int64)
    return Counts(chunks, doc, pair, times, word, history, count, word_at, word[first], word_count)


def tally(count: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, ... K + 1."""
    return np.bincount(count[(count > 0) & (count <= K + 1)], minlength=K + 2)[1:]


def statistics(blobs, heavy: np.ndarray, hot: Hot):
    """Counts of counts of words and bigrams, N, V, starts, the frequent words' and bigrams' counts."""
    give_back()
    found = counts_of(blobs)
    if found is None:
        return
    light = ~among(found.words, heavy)
    own = found.word_count[light]
    many = dict(zip(found.words[~light].tolist(), found.word_count[~light].tolist()))
    starts = int(found.count[found.history == START].sum())
    often, at = hot.find(found.word, found.history)
    pairs = narrow(at), found.count[often]
    yield tally(own), tally(found.count[~often]), int(found.count.sum()), int((own > 0).sum()), starts, many, pairs


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing factor for counts 0 to K, and 1 at K + 1 for all above.

    Where counts of counts give no factor over 0 and up to 1, as in small corpora, the factor is
    that of one count less in the count's own place: r / (r + 1).
    """
    out = np.ones(K + 2)
    cut = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        good = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        d = (good - cut) / (1 - cut) if cut < 1 else 0.0
        out[r] = d if 0 < d <= 1 else r / (r + 1)
    return out


@dataclass
class Model:
    one: np.ndarray    # discounts of words
    two: np.ndarray    # of bigrams
    total: int         # N, training tokens
    types: int         # V
    unknown: float     # probability of a word never seen
    heavy: np.ndarray
    heavy_count: np.ndarray
    hot: Hot
    hot_count: np.ndarray

    def word_counts(self, found: Counts) -> np.ndarray:
        count = found.word_count.copy()
        many = among(found.words, self.heavy)
        if many.any():
            count[many] = self.heavy_count[np.searchsorted(self.heavy, found.words[many])]
        return count

    def pair_counts(self, found: Counts) -> tuple[np.ndarray, np.ndarray]:
        """Of all texts, and which of the bigrams are hot."""
        count = found.count.copy()
        often, at = self.hot.find(found.word, found.history)
        count[often] = self.hot_count[at]
        return count, often

    def hot_followers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """History, count and the word's count of the hot bigrams seen."""
        seen = self.hot_count > 0
        return (
            self.hot.history[seen], self.hot_count[seen],
            self.heavy_count[np.searchsorted(self.heavy, self.hot.word[seen])],
        )

    def log_word(self, count: np.ndarray) -> np.ndarray:
        seen = self.one[np.minimum(count, K + 1)] * np.maximum(count, 1) / (self.total + 1)
        return np.log10(np.where(count > 0, seen, self.unknown))


def both(a: tuple | None, b: tuple | None) -> tuple | None:
    """Statistics of two partitions or groups of them, added up."""
    if a is None or b is None:
        return b if a is None else a
    sums = tuple(x + y for x, y in zip(a[:5], b[:5]))
    few, many = sorted((a[5], b[5]), key=len)
    many = dict(many)
    for word, count in few.items():
        many[word] = many.get(word, 0) + count
    at, where = np.unique(np.concatenate((a[6][0], b[6][0])), return_inverse=True)
    times = np.bincount(where, weights=np.concatenate((a[6][1], b[6][1])), minlength=len(at))
    return *sums, many, (at, times.astype(np.int64))


def model_of(found: tuple | None, heavy: np.ndarray, hot: Hot) -> Model:
    none = np.zeros(K + 1, np.int64)
    n1, n2, total, types, _, many, (at, times) = found or (none, none, 0, 0, 0, {}, (np.zeros(0, np.int64),) * 2)
    hot_count = np.zeros(len(hot.key), np.int64)
    hot_count[at] = times
    heavy_count = np.array([many.get(int(w), 0) for w in heavy], np.int64)
    n1, n2 = n1 + tally(heavy_count), n2 + tally(hot_count)
    types += int((heavy_count > 0).sum())
    one, two = discounts(n1), discounts(n2)
    less = sum(r * (1 - one[r]) * int(n1[r - 1]) for r in range(1, K + 1))
    return Model(one, two, total, types, (1 + less) / (total + 1), heavy, heavy_count, hot, hot_count)


def follower_columns(count: np.ndarray, word_count: np.ndarray) -> list[np.ndarray]:
    """What a history sums over its followers."""
    columns = [count, np.where(word_count > K, word_count, 0)]
    columns += [(count == r).astype(np.int64) for r in range(1, K + 1)]
    return columns + [(word_count == r).astype(np.int64) for r in range(1, K + 1)]


def word_side(blobs, model: Model, histories: int, doc_parts: int):
    """(target, kind, packed) of what one partition knows of its bigrams and their documents, and
    the ids it has to pass on."""
    own = []
    for is_ids, blob in blobs:
        if is_ids:
            key = unpack(blob)[0].tolist()
            yield histories + hash(tuple(key[:2])) % doc_parts, ("ids", tuple(key), blob)
        else:
            own.append(blob)
    give_back()
    found = counts_of(own)
    del own
    if found is None:
        return
    words = model.word_counts(found)
    pair_word = words[found.word_at]
    count, often = model.pair_counts(found)
    seen = count > 0
    n_docs = found.starts[-1]
    by_doc = lambda weight: np.bincount(found.doc, weights=weight[found.pair] * found.times, minlength=n_docs)
    # The count of a word as history is its count as token; ends are no history, starts no token.
    before = np.where((found.word != END) & (pair_word > 0), np.log10(pair_word + 1.0), 0.0)
    bigram = model.two[np.minimum(count, K + 1)] * np.maximum(count, 1)
    score = by_doc(np.where(seen, np.log10(bigram), model.log_word(pair_word)) - before)
    base = by_doc(np.log10(pair_word + 1.0))
    tokens = np.bincount(found.doc, weights=found.times, minlength=n_docs).astype(np.int64)
    known = by_doc((pair_word > 0).astype(float)).astype(np.int64)
    for (key, present, _), a, b in zip(found.chunks, found.starts[:-1], found.starts[1:]):
        yield histories + hash(key[:2]) % doc_parts, ("doc", key, pack(
            narrow(np.diff(present, prepend=0)), score[a:b], base[a:b], narrow(tokens[a:b]), narrow(known[a:b]),
        ))
    # What histories need: their followers, and who met a bigram that was never seen.
    part = (mixed(found.history) % np.uint64(histories)).astype(np.int64)
    own = seen & ~often
    order = np.lexsort((found.history[own], part[own]))
    h, p = found.history[own][order], part[own][order]
    c, w = count[own][order], pair_word[own][order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    add = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64)
    columns = [add(x) for x in follower_columns(c, w)]
    h, p = h[first], p[first]
    edges = np.searchsorted(p, np.arange(histories + 1))
    odd = np.flatnonzero(~seen[found.pair])
    odd_part = part[found.pair[odd]]
    odd = odd[np.argsort(odd_part, kind="stable")]
    odd_edges = np.searchsorted(np.sort(odd_part), np.arange(histories + 1))
    numbers = np.concatenate([c[1] for c in found.chunks])
    for q in range(histories):
        a, b = edges[q], edges[q + 1]
        if a < b:
            yield q, ("history", None, pack(
                np.diff(h[a:b], prepend=np.uint64(0)), columns[0][a:b], columns[1][a:b],
                *(narrow(x[a:b]) for x in columns[2:]),
            ))
        own = odd[odd_edges[q] : odd_edges[q + 1]]
        if len(own):
            chunk = np.searchsorted(found.starts, found.doc[own], side="right") - 1
            keys = np.array([c[0] for c in found.chunks], np.int64)[chunk]
            yield q, ("unseen", None, pack(
                found.history[found.pair[own]], keys[:, 0], keys[:, 1],
                narrow(numbers[found.doc[own]]), found.times[own],
            ))


def history_side(rows, model: Model, starts: int):
    """Partial sums (task, chunk, doc number, id or None, held out, tokens, known, base, score)."""
    give_back()
    followers, odd, docs = [], [], {}
    for _, (kind, key, blob) in rows:
        x = unpack(blob)
        if kind == "history":
            followers.append([np.cumsum(x[0], dtype=np.uint64), *(y.astype(np.int64) for y in x[1:])])
        elif kind == "unseen":
            odd.append(x)
        else:
            if key not in docs:
                n = key[2]
                docs[key] = [None, np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)]
            if kind == "ids":
                docs[key][0] = x[1:]
            else:
                at = np.cumsum(x[0], dtype=np.int64)
                for sums, some in zip(docs[key][1:], x[1:]):
                    sums[at] += some
    for (task, chunk, _), ((names, there, flags), score, base, tokens, known) in docs.items():
        # Every text has one start, whose count no word's partition knows.
        score = score - np.log10(starts + 1.0) * (starts > 0)
        base = base - tokens * np.log10(model.total + model.types + 1)
        for i in range(len(names)):
            yield (
                task, chunk, i, int(names[i]) if there[i] else None, bool(flags[i]), int(tokens[i]),
                int(known[i]), float(base[i]), float(score[i]),
            )
    if not odd:
        return
    history, task, chunk, doc, times = (np.concatenate([x[i] for x in odd]) for i in range(5))
    before, count, word_count = model.hot_followers()
    followers.append([before, *follower_columns(count, word_count)])
    adjust = np.zeros(len(history))
    if followers:
        h, *columns = (np.concatenate([x[i] for x in followers]) for i in range(3 + 2 * K))
        names, at = np.unique(h, return_inverse=True)
        columns = [np.bincount(at, weights=c, minlength=len(names)) for c in columns]
        count, large = columns[:2]
        few, rare = columns[2 : 2 + K], columns[2 + K :]
        kept = count - sum(r * (1 - model.two[r]) * few[r - 1] for r in range(1, K + 1))
        lower = large + sum(r * model.one[r] * rare[r - 1] for r in range(1, K + 1))
        weight = (1 - kept / (count + 1)) / (1 - lower / (model.total + 1))
        # The word's side has taken the seen form's denominator off; it goes back on.
        change = np.log10(weight) + np.log10(count + 1)
        known = among(history, names)
        adjust[known] = change[np.searchsorted(names, history[known])]
    keys, at = np.unique(np.stack([task, chunk, doc.astype(np.int64)]), axis=1, return_inverse=True)
    for (t, c, d), s in zip(keys.T.tolist(), np.bincount(at.ravel(), weights=adjust * times).tolist()):
        yield t, c, d, None, False, 0, 0, 0.0, s


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Per row: doc (long), held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trained on rows whose crc32 of the id as text, modulo ``folds``, is not ``fold``; a row with a
    null id trains. A null or empty text has one token, its end. base_score is the add-one unigram
    score. Repeated rows each count and each get their score. An empty table gives no rows. Without
    any training token all probability is the unknown word's. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    heavy, hot = frequent(texts, parts)

    def chunked(batches):
        for p, is_ids, blob in bigram_chunks(batches, parts, heavy, hot, folds, fold):
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([is_ids]), pa.array([blob], pa.binary())], ["part", "ids", "blob"]
            )

    chunks = texts.mapInArrow(chunked, "part int, ids boolean, blob binary").rdd.map(lambda r: (r[0], (r[1], bytes(r[2]))))
    by_word = chunks.partitionBy(parts, int)
    counted = by_word.mapPartitions(
        lambda rows: statistics((blob for _, (is_ids, blob) in rows if not is_ids), heavy, hot)
    )
    # In a tree, so that the driver gets few of the lists of frequent words.
    found = counted.treeAggregate(None, both, both)
    model, starts = model_of(found, heavy, hot), found[4] if found else 0
    doc_parts = max(1, parts // 4)
    sides = by_word.mapPartitions(
        lambda rows: word_side((x for _, x in rows), model, parts, doc_parts)
    ).partitionBy(parts + doc_parts, int)
    sums = sides.mapPartitions(lambda rows: history_side(rows, model, starts))
    fields = (
        "task bigint, chunk bigint, at bigint, doc bigint, held_out boolean, tokens bigint, "
        "known bigint, base double, score double"
    )
    rows = spark.createDataFrame(sums, fields, verifySchema=False)
    return rows.groupBy("task", "chunk", "at").agg(
        F.max("doc").alias("doc"), F.max("held_out").alias("held_out"),
        F.sum("tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).select(
        "doc", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
