"""Training sequences of similar documents, by retrieval from a sharded BM25 index."""

from __future__ import annotations

import codecs
import json
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.tables import give_back, written
from termtide.llm.textscan import Texts, Words, _hashed, mixed, pieces, spans_of, texts_of, words_of

WINDOW = 2048
#: Follows every document. Fixed value.
DOCUMENT_END = 1
SHARD_BYTES = 8 << 20
K1, B = 1.2, 0.75
#: Bits of a document's place in the dealing: of each of its two words, and of its salt.
WORD_BITS, SALT_BITS = 20, 23
#: Bytes of text whose words are looked at together.
STRETCH = 1 << 20
#: Steps of a word's rarity by which words are picked for the list.
RARITIES = 1 << 15
#: Counts of words that a task holds before it sends them on.
COUNTED = 1 << 20
#: Words a worker remembers the ids of.
REMEMBERED = 1_000_000
_known: dict[str, "Vocabulary"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# The steps before the model for which words of Latin letters, digits and marks go to it in pieces.
STEPS = [
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
]
#: Words that these steps only put in lower case and part as `PIECES` does: what they do to other letters and blanks, to
#: an apostrophe, and to a bar, which special names have, is left to them.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
SIMPLE = re.compile(rf"[{LATIN}0-9!-&(-/:-@\[-`{{}}~]+")
PIECES = re.compile(rf"[{LATIN}]+|[0-9]|[^{LATIN}0-9]+")
#: Byte-level models name the bytes without a visible form by the characters from 256 on, in order.
BYTES = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
NAMES = "".join(chr(BYTES.get(b, b)) for b in range(256))
#: Bytes that the tokenizer parts from a letter or digit before them.
TAIL = np.zeros(256, bool)
TAIL[[*b".,;:!?"]] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True


class Vocabulary:
    """The tokenizer's ids of the words seen so far, by the words' 64-bit hashes, in flat arrays.
    Before all others the pool of ids holds the end of document.

    A worker keeps it from one shard to the next, so it tokenises each different word once. Beyond
    `REMEMBERED` words only those of the last shard stay. That two of so many words have one
    hash is to be expected once in ten million such vocabularies.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(tokenizer)
        steps = json.loads(self.tool.to_str())
        self.plain = steps["model"]["type"] == "BPE" and [steps[k] for k in ("normalizer", "pre_tokenizer")] == STEPS
        self.hash = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.uint32)
        self.pool = np.array([DOCUMENT_END], np.uint32)

    def find(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Places of different words; ``first`` and ``size`` say where the bytes of each lie."""
        new = np.arange(len(hashes))
        if len(self.hash):
            at = np.minimum(places_in(self.hash, hashes), len(self.hash) - 1)
            new = np.flatnonzero(self.hash[at] != hashes)
        if len(new):
            self._add(hashes[new], data, first[new], size[new])
        return places_in(self.hash, hashes)

    def _add(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        parts, sizes, ask = [self.pool], [], self.tool.model.tokenize
        for a in range(0, len(hashes), 10_000):
            words = strings(data, first[a : a + 10_000], size[a : a + 10_000])
            asked = [self._pieces(w) for w in words]
            other = [i for i, x in enumerate(asked) if x is None]
            whole = self.tool.encode_batch_fast([words[i] for i in other], add_special_tokens=False)
            found = [x and [t.id for piece in x for t in ask(piece)] for x in asked]
            for i, e in zip(other, whole):
                found[i] = e.ids
            sizes.append(np.fromiter(map(len, found), np.uint32, len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32))
        size = np.concatenate(sizes)
        first = np.concatenate((self.first, (len(self.pool) + np.cumsum(size, dtype=np.int64) - size).astype(np.uint32)))
        self.pool = np.concatenate(parts)
        del parts
        both = np.concatenate((self.hash, hashes))
        order = np.argsort(both, kind="stable")
        self.hash, self.first, self.size = both[order], first[order], np.concatenate((self.size, size))[order]

    def _pieces(self, word: str) -> list[str] | None:
        """What the tokenizer's first steps make of a word of Latin letters, digits and marks, so that its
        model can be asked directly, which takes a third of the time; None for any other."""
        if not self.plain:
            return None
        if word.isascii() and word.isalpha():
            return [word.lower()]
        if not SIMPLE.fullmatch(word):
            return None
        found = PIECES.findall(word.lower())
        return found if word.isascii() else [codecs.charmap_decode(x.encode(), "strict", NAMES)[0] for x in found]

    def forget(self, kept: np.ndarray) -> None:
        """All words but those at some places, in order."""
        size = self.size[kept].astype(np.int64)
        self.pool = np.concatenate((self.pool[:1], self.pool[spans(self.first[kept].astype(np.int64), size)]))
        first = (1 + np.cumsum(size) - size).astype(np.uint32)
        self.hash, self.first, self.size = self.hash[kept], first, size.astype(np.uint32)


def places_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """`np.searchsorted`, asked in order, so that a long array is passed through once."""
    order = np.argsort(values)
    out = np.empty(len(values), np.int64)
    out[order] = np.searchsorted(ordered, values[order])
    return out


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each span, one after the other."""
    return np.arange(size.sum()) + (first - np.cumsum(size) + size).repeat(size)


def strings(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[str]:
    """The texts that lie in some spans of bytes."""
    offset = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int64())
    held = pa.py_buffer(data[spans(first, size)])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, offset.buffers()[1], held]).to_pylist()


def first_seen(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values numbered in the order in which they come, the different ones, and where each comes first."""
    number, different = pd.factorize(values)
    return number, different, np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))


def word_parts(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words of texts, the punctuation at a word's end apart, and which of them such punctuation is.

    The hash is of the word with A-Z in lower case, as the tokenizer has no case. A word with a
    bar may be one of its special names, which do have case: its hash is of the word as it is.
    """
    row, begin, stop = spans_of(texts)
    core, left = stop.copy(), np.arange(len(row))
    while len(left):
        left = left[(core[left] > begin[left]) & TAIL[texts.data[np.maximum(core[left] - 1, 0)]]]
        core[left] -= 1
    apart = np.zeros(len(core), bool)
    if len(core):
        apart = (core < stop) & (core > begin) & ALNUM[texts.data[np.maximum(core - 1, 0)]]
    at = np.arange(len(core)).repeat(1 + apart)
    tail = np.zeros(len(at), bool)
    tail[1:] = at[1:] == at[:-1]
    first, end = begin[at], stop[at]
    first[tail] = core[at[tail]]
    head = np.flatnonzero(tail) - 1
    end[head] = core[at[head]]
    value = _hashed(texts.data, first, end)
    if len(first):
        # A bar is no blank, so it lies in the last word that begins before it.
        named = np.unique(np.searchsorted(first, np.flatnonzero(texts.data == ord("|")), side="right") - 1)
        if len(named):
            as_is = np.arange(256, dtype=np.uint8)
            value[named] = mixed(_hashed(texts.data, first[named], end[named], as_is) + np.uint64(1))
    return Words(value, row[at], first, end), tail


def stretches(offset: np.ndarray, most_bytes: int) -> list[tuple[int, int]]:
    """From which text to which, about that much each; a longer text is one of its own."""
    group = (offset[:-1] - offset[0]) // most_bytes
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=group[-1] + 1)) if len(group) else np.zeros(0, int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def token_ids(column: pa.Array, tokenizer: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of every text with the end of document, and its words, numbered within the call and
    without the punctuation at their ends.

    The tokenizer drops white space and lets nothing cross it, so the ids of a text are those of
    its words, one after the other. Words are found and numbered, and ids put together, a stretch of texts at a time:
    what is held of a word in between is 5 bytes, and 24 more of each that the stretch has not had before.
    """
    if tokenizer not in _known:
        _known[tokenizer] = Vocabulary(tokenizer)
    vocabulary = _known[tokenizer]
    texts, found, ids, bags = texts_of(column), [], [], []
    parts = stretches(texts.offset, STRETCH)
    if not parts:
        return ids, bags
    for a, b in parts:
        base = texts.offset[a]
        words, tail = word_parts(Texts(texts.data[base : texts.offset[b]], texts.offset[a : b + 1] - base))
        number, value, at = first_seen(words.hash)
        where, count = words.first[at] + base, np.bincount(words.row, minlength=b - a)
        found.append((value, where, words.end[at] - words.first[at], number.astype(np.int32), tail, count))
    value, where, long, numbers, tails, counts = zip(*found)
    # Numbers follow the order in which words come.
    number, different, at = first_seen(np.concatenate(value))
    place = vocabulary.find(different, texts.data, np.concatenate(where)[at], np.concatenate(long)[at])
    number = np.split(number.astype(np.int32), np.cumsum([len(x) for x in value])[:-1])
    del found, value, where, long
    begins, held = vocabulary.first[place].astype(np.int64), vocabulary.size[place].astype(np.int64)
    for known, of, tail, count in zip(number, numbers, tails, counts):
        some, upto = known[of], np.cumsum(count)
        # After the words of a text comes its end.
        size = np.insert(held[some], upto, 1)
        tokens = vocabulary.pool[spans(np.insert(begins[some], upto, 0), size)].astype("<u4", copy=False)
        total = np.add.reduceat(size, upto - count + np.arange(len(count)))
        ids += np.split(tokens, np.cumsum(total)[:-1])
        bags += np.split(some[~tail], np.concatenate(([0], np.cumsum(~tail)))[upto[:-1]])
    if len(vocabulary.hash) > REMEMBERED:
        vocabulary.forget(np.unique(place))
    return ids, bags


class Index:
    """BM25 over bags of numbered words."""

    def __init__(self, bags: list[np.ndarray]):
        n = len(bags)
        size = np.array([len(b) for b in bags])
        word = np.concatenate(bags)
        # A word that comes once is in one bag and finds nothing.
        twice = (np.bincount(word) > 1)[word]
        pairs = word[twice].astype(np.int64) * n + np.arange(n, dtype=np.int32).repeat(size)[twice]
        del word, twice
        pairs.sort()
        opens = np.flatnonzero(np.diff(pairs, prepend=-1))
        times, pairs = np.diff(opens, append=len(pairs)), pairs[opens]
        term, owner = pairs // n, pairs % n
        del pairs, opens
        _, first, held = np.unique(term, return_index=True, return_counts=True)
        idf = np.log((n - held + 0.5) / (held + 0.5))
        # Terms in half of all bags or more tell nothing apart.
        useful = (idf > 0) & (held > 1)
        weight = idf.repeat(held) * times * (K1 + 1) / (
            times + K1 * (1 - B + B * size[owner] / max(size.mean(), 1))
        )
        self.n, self.owner, self.weight = n, owner, weight
        self.first, self.held = first, held
        group = np.arange(len(first)).repeat(held)
        told = useful[group]
        group, by = group[told], owner[told].astype(np.uint16 if n < 1 << 16 else np.int64)
        order = np.argsort(by, kind="stable")
        self.terms = group[order]
        self.edges = np.searchsorted(by[order], np.arange(n + 1))

    def scores(self, bag: int) -> np.ndarray:
        """Of all bags, for the terms of one."""
        terms = self.terms[self.edges[bag] : self.edges[bag + 1]]
        held = self.held[terms]
        at = np.arange(held.sum()) + (self.first[terms] - np.cumsum(held) + held).repeat(held)
        return np.bincount(self.owner[at], weights=self.weight[at], minlength=self.n)


def filled(size: list[int], bags: list[np.ndarray], window: int):
    """Sequences, as lists of (tail, from, to): a seed, then its best unused neighbours.

    ``size``: tokens of each tail, ``bags``: the words of its document. The neighbour that doesn't
    fit is cut, and its rest is the next seed. Where no neighbour shares a word, the next unused
    tail follows.
    """
    if not size:
        return
    index, unused, after, seed = Index(bags), np.ones(len(size), bool), 0, None
    while seed is not None or unused.any():
        if seed is None:
            seed = int(unused.argmax()), 0
            unused[seed[0]] = False
        tail, start = seed
        now, room, seed = [(tail, start, size[tail])], window - (size[tail] - start), None
        scores = index.scores(tail)
        while room > 0 and unused.any():
            scores[~unused] = -1.0
            tail = int(scores.argmax())
            if scores[tail] <= 0:
                tail = after = after + int(unused[after:].argmax())
            unused[tail] = False
            take = min(room, size[tail])
            now.append((tail, 0, take))
            room -= take
            if take < size[tail]:
                seed = tail, take
        yield now


def sequences(ids: list[np.ndarray], bags: list[np.ndarray], window: int):
    """Sequences of pieces (document, start, length): whole windows of long documents, then the
    packed tails; the last, unfilled one is cut at powers of two."""
    tails, words, where = [], [], []
    for d, tokens in enumerate(ids):
        whole = len(tokens) // window * window
        for start in range(0, whole, window):
            yield [(d, start, window)]
        if whole < len(tokens):
            tails.append(len(tokens) - whole)
            words.append(bags[d])
            where.append((d, whole))
    for now in filled(tails, words, window):
        pieces = [(where[t][0], where[t][1] + a, b - a) for t, a, b in now]
        size = sum(p[2] for p in pieces)
        if size == window:
            yield pieces
            continue
        while size:
            room = 1 << (size.bit_length() - 1)
            size -= room
            part = []
            while room:
                d, start, length = pieces.pop(0)
                take = min(room, length)
                part.append((d, start, take))
                room -= take
                if take < length:
                    pieces.insert(0, (d, start + take, length - take))
            yield part


def rarity(word: np.ndarray, held: np.ndarray, n: int, shards: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """By what words are ordered, in a random order in which rare ones tend to come first: whether a word fills more
    than some shards, and a number of 0 or more."""
    idf = np.log((n - held + 0.5) / (held + 0.5))
    chance = (mixed(word + np.uint64(turn)) >> np.uint64(11)).astype(float) / (1 << 53)
    return held * shards > 8 * n, -np.log(chance + 1e-300) / idf


def ranks_of(word: np.ndarray, held: np.ndarray, n: int, shards: int):
    """Sorted words, and two random orders of them in which rare words tend to come first.

    ``held``: in how many of ``n`` documents a word is. Words that fill more than some shards come
    after all others. Beyond what `WORD_BITS` can number, those that come first in one order are kept.
    """
    order = np.argsort(word)
    word, held = word[order], held[order]
    late, by = rarity(word, held, n, shards, 1)
    kept = np.sort(np.lexsort((by, late))[: 1 << WORD_BITS])
    word, held, ranks = word[kept], held[kept], []
    for turn in (1, 2):
        late, by = rarity(word, held, n, shards, turn)
        rank = np.empty(len(word), np.int32)
        rank[np.lexsort((by, late))] = np.arange(len(word))
        ranks.append(rank)
    return word, *ranks


def added_up(word: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different words in order, and what they have in all."""
    order = np.argsort(word)
    word, held = word[order], held[order]
    first = np.flatnonzero(np.diff(word, prepend=word[:1] ^ np.uint64(1)))
    return word[first], np.add.reduceat(held, first) if len(first) else held


def word_counts(texts: DataFrame, n: int, shards: int) -> DataFrame:
    """word (its hash as a long), held: in how many of all ``n`` texts it is, and rated, which grows with the place of
    the word in the first order of `ranks_of`. Words of one text and of half of them are left out.

    Counts go by stretches of the hash, as arrays: a row a word would take several times as long.
    """
    parts = max(1, min(shards // 8, 1 << 16))
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def sent(found):
        word, held = added_up(*map(np.concatenate, zip(*found)))
        cuts = [0, *np.searchsorted(word, edges).tolist(), len(word)]
        rows = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        blobs = [[x[a:b].tobytes() for _, a, b in rows] for x in (word, held.astype(np.int64))]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)],
            ["part", "words", "held"],
        )

    def counted(batches):
        found, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text", STRETCH):
                words = words_of(texts_of(piece.column("text")))
                # A word and its row as one number, as sorting by both would take longer than all else here.
                both = mixed(words.hash + mixed(words.row.astype(np.uint64)))
                number, word = pd.factorize(words.hash[~pd.Series(both).duplicated().to_numpy()])
                found.append((word, np.bincount(number, minlength=len(word))))
                size += len(word)
                if size > COUNTED:
                    yield sent(found)
                    found, size = [], 0
        if found:
            yield sent(found)
        found = None
        give_back()

    def summed(key, table):
        word, held = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("words", "u8"), ("held", "i8")))
        word, held = added_up(word, held)
        kept = (held > 1) & (2 * held < n)
        word, held = word[kept], held[kept]
        late, by = rarity(word, held, n, shards, 1)
        rated = np.minimum(np.floor(RARITIES * by / (1 + by)), RARITIES - 1).astype(np.int64) + RARITIES * late
        return pa.table({"word": word.view(np.int64), "held": held, "rated": rated})

    rows = texts.select("text").mapInArrow(counted, "part int, words binary, held binary")
    return rows.groupBy("part").applyInArrow(summed, "word bigint, held bigint, rated bigint")


def listed_words(texts: DataFrame, n: int, shards: int):
    """`ranks_of` over the words of all ``texts``, but those of half of them and of one.

    The driver gets no more words than can be numbered, and those as rare as the last: which these are is found from
    a count of words by rarity.
    """
    words = written(word_counts(texts, n, shards), "words")
    if words.count() > 1 << WORD_BITS:
        steps = words.groupBy("rated").count().orderBy("rated").toArrow()
        upto = np.cumsum(steps.column("count").to_numpy())
        last = int(steps.column("rated")[int(np.searchsorted(upto, 1 << WORD_BITS))].as_py())
        words = words.where(F.col("rated") <= last)
    table = words.select("word", "held").toArrow()
    word, held = (table.column(c).to_numpy() for c in ("word", "held"))
    return ranks_of(word.view(np.uint64), held, n, shards)


def places_of(column: pa.Array, salt: np.ndarray, ranked) -> np.ndarray:
    """Where documents stand in the dealing: by their first word in one order, by that in the other,
    and by a salt. Without a word of the list, anywhere."""
    word, *ranks = ranked
    words = words_of(texts_of(column))
    salt = mixed(salt.view(np.uint64))
    bits = 2 * WORD_BITS + SALT_BITS
    place = (salt >> np.uint64(64 - bits)).astype(np.int64)
    if not len(word) or not len(words.hash):
        return place
    # Different words only, in order, are looked up: the list may be long.
    number, different = pd.factorize(words.hash)
    found = np.minimum(places_in(word, different), len(word) - 1)
    found[word[found] != different] = -1
    at = found[number]
    known = at >= 0
    at, row = at[known], words.row[known]
    if len(at):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        one, two = (np.minimum.reduceat(rank[at], first).astype(np.int64) for rank in ranks)
        low = place[row[first]] & ((1 << SALT_BITS) - 1)
        if len(word) < 1 << WORD_BITS:
            one = one * (1 << WORD_BITS) // len(word)
        place[row[first]] = (((one << WORD_BITS) + two) << SALT_BITS) + low
    return place


def cuts_of(sizes: DataFrame, shards: int) -> np.ndarray:
    """Where to cut the order of documents into shards of like size: the last place of each shard but the last one.

    ``sizes`` has place and size of every document. They are sorted by ranges of the place; what the ranges
    add up to, and one place a shard, are all that comes to the driver.
    """
    ranged = written(sizes.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "places")
    ends = ranged.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect()
    total = sum(r["size"] for r in ends)
    if not total:
        return np.zeros(0, np.int64)
    begins, upto = [], 0
    for r in ends:
        begins.append((r["part"], upto))
        upto += r["size"]
    begins = sizes.sparkSession.createDataFrame(begins, "part int, begins long")
    upto = F.col("begins") + F.sum("size").over(Window.partitionBy("part").orderBy("place"))
    reached = ranged.join(F.broadcast(begins), "part").select("place", upto.alias("upto"))
    reached = reached.groupBy(F.floor(F.col("upto") * F.lit(float(shards)) / total).alias("shard")).agg(F.min("place"))
    first = dict(map(tuple, reached.where("shard > 0").collect()))
    cuts, place = np.zeros(shards - 1, np.int64), max(first.values())
    for shard in range(shards, 0, -1):
        place = first.get(shard, place)
        if shard < shards:
            cuts[shard - 1] = place
    return cuts


def dealt(texts: DataFrame, n: int, shards: int) -> DataFrame:
    """``texts`` with the shard of each: documents are put in an order in which those that share rare
    words lie together, and the order is cut into shards of like size in bytes.

    A document's place is a min-hash of its words, rare ones first, then a second one, then
    a salt, so the documents of a hot word part by their other words, and like ones by the salt. How
    rare words are, and where to cut, is counted over all documents; the texts are written once with their places.
    """
    if shards == 1:
        return texts.select("doc", "text", F.lit(0).cast("long").alias("shard"))
    ranked = listed_words(texts, n, shards)
    kind = texts.schema["doc"].dataType.simpleString()

    def placed(batches):
        for batch in batches:
            for piece in pieces(batch, "text", STRETCH):
                text = piece.column("text")
                place = places_of(text, piece.column("salt").to_numpy(), ranked)
                size = np.diff(texts_of(text).offset)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), text, pa.array(place), pa.array(size)], ["doc", "text", "place", "size"]
                )
        give_back()

    salted = texts.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    found = written(salted.mapInArrow(placed, f"doc {kind}, text string, place bigint, size bigint"), "placed")
    cuts = cuts_of(found.select("place", "size"), shards)

    @F.pandas_udf("bigint")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, place.to_numpy()))

    return found.select("doc", "text", shard_of("place").alias("shard"))


def pack_documents(
    docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id",
    text_col: str = "text", tokenizer: str | None = None,
) -> DataFrame:
    """Per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset.

    Every token of every document, with an end after each, lies in exactly one piece. Sequences hold
    ``window`` tokens; only the last window of a shard is shorter, and is cut into sequences of
    powers of two. A null or empty text is just its end. A repeated row or id is a document of its
    own, and neither a text, a word nor an id makes a shard large.
    An empty table gives no rows. Other columns are not read.

    Documents that share rare words are dealt to the same shard (see ``dealt``). A shard is some
    ``shard_bytes`` of text, and one task: it tokenises, indexes the
    documents with tails left of whole windows, and asks the index for neighbours of one seed after the other. No seed
    asks another shard, as which documents are unused is known in a shard only.
    """
    tokenizer = tokenizer or default_tokenizer()
    size, n = docs.agg(F.sum(F.octet_length(text_col)), F.count(F.lit(1))).first()
    shards = max(1, -(-(size or 0) // shard_bytes))
    texts = dealt(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), n, shards)
    kind = texts.schema["doc"].dataType.simpleString()

    def packed(key, table):
        names = table.column("doc").combine_chunks()
        ids, bags = token_ids(table.column("text").combine_chunks(), tokenizer)
        del table
        give_back()
        base, rows, blobs = key[0].as_py() << 32, [], []
        for number, now in enumerate(sequences(ids, bags, window)):
            offset = 0
            for d, start, length in now:
                rows.append((d, start, length, len(ids[d]), base + number, offset))
                blobs.append(ids[d][start : start + length].tobytes())
                offset += length
        del ids, bags
        d, *numbers = np.array(rows, np.int64).reshape(-1, 6).T
        start, length, total, sequence, offset = (pa.array(np.ascontiguousarray(x)) for x in numbers)
        out = pa.table({
            "doc": names.take(pa.array(d)), "start": start, "length": length,
            "ids": pa.array(blobs, pa.binary()), "doc_tokens": total, "sequence_id": sequence,
            "offset": offset,
        })
        del rows, blobs
        give_back()
        return out

    numbers = "doc_tokens bigint, sequence_id bigint, offset bigint"
    return texts.groupBy("shard").applyInArrow(
        packed, f"doc {kind}, start bigint, length bigint, ids binary, {numbers}"
    ).withColumnRenamed("doc", id_col)
