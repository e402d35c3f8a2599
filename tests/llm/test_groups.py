"""Components, near duplicates, embeddings, language model, packing and the pipeline."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from termtide.llm import hnsw, katz, near_dup, packing, queries
from termtide.llm.components import components, roots


def least_of(links, nodes):
    low = roots(links)
    return {x: low.get(x, x) for x in nodes}


def test_components(spark):
    pick = random.Random(3)
    chain = [(i, i + 1) for i in range(40)]
    some = [(pick.randrange(100, 160), pick.randrange(100, 160)) for _ in range(40)]
    links = chain + some + [(500, 900 + i) for i in range(50)] + [(7, 7), (3, 2), (3, 2)]
    pick.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long").repartition(5)).collect()}
    assert got == roots(links)
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_groups(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    low = least_of(links, ids)
    return {i: (len(sets[i]), low[i], low[i] == i) for i in ids}


def found_groups(rows, **k):
    return {r.doc: (r.n_shingles, r.component, r.kept) for r in near_dup.near_duplicates(rows, **k).collect()}


def variants(prose, n, changed, seed):
    """Copies of one text, each with some words of its own: often alike two by two, often not."""
    base, pick = prose(120, seed), random.Random(seed)
    for i in range(n):
        words = list(base)
        for _ in range(pick.randrange(changed)):
            words[pick.randrange(len(words))] = f"own{pick.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("block", [16, near_dup.BLOCK])
def test_groups_by_brute_force(docs, prose, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    texts = [*variants(prose, 60, 12, 1), *variants(prose, 40, 5, 2)]
    passage = " ".join(prose(70, 9))
    texts += [f"{passage} {' '.join(prose(20, 50 + i))}" for i in range(40)]
    texts += ["One two Three", "one two three", "one two", "w", None, "", "  ", texts[3], texts[3]]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    assert found_groups(docs(*rows), words=4) == plain_groups(rows, 4)


@pytest.mark.parametrize("odd", [1, 30])
def test_members_of_a_hot_bucket_are_placed_once(spark, odd):
    """One component of 5,000 and some others in one bucket: few rows, and every pair meets."""
    rows = [(1, 5000 + odd, i, 0 if i < 5000 else i) for i in range(5000 + odd)]
    inside = spark.createDataFrame(rows, "bucket long, size long, doc long, component long")
    placed = near_dup.blocks_of(inside).collect()
    blocks = -(-(5000 + odd) // near_dup.BLOCK)
    assert len(placed) == 5000 + odd + odd * blocks
    met = defaultdict(lambda: (set(), set()))
    for r in placed:
        met[r.bucket, r.x, r.y][r.side].add(r.doc)
    assert max(len(a) for a, _ in met.values()) < 2 * near_dup.BLOCK
    pairs = {(v, u) for residents, visitors in met.values() for v in visitors for u in residents}
    assert pairs == {(v, u) for v in range(5000, 5000 + odd) for u in range(5000 + odd)}


def test_repeated_and_null_ids(docs, prose):
    a, b = " ".join(prose(50, 1)), " ".join(prose(50, 2))
    rows = docs((5, a), (5, b), (7, b), (8, a), (None, a), (5, a), (9, None))
    got = [tuple(r) for r in near_dup.near_duplicates(rows).collect()]
    assert sorted(got, key=repr) == sorted([
        (5, 46, 5, True), (5, 46, 5, True), (5, 46, 5, True), (7, 46, 5, False), (8, 46, 5, False),
        (None, 46, None, True), (9, 0, 9, True),
    ], key=repr)
    kept = near_dup.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [5, 9, None]
    assert near_dup.near_duplicates(docs()).count() == near_dup.keep_one(docs()).count() == 0


def test_documents_by_brute_force(spark, small, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.QUERIES["op6_minhash_near_dedup"](spark, small).collect()}
    assert got == plain_groups(rows, 4)


def test_super_minhash_estimates():
    pick = np.random.default_rng(1)
    for n in (3, 40, 600):
        both = pick.integers(0, 1 << 63, n, dtype=np.uint64)
        sets = [np.unique(np.append(both, pick.integers(0, 1 << 63, n // 3, dtype=np.uint64))) for _ in range(2)]
        row = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
        one, two = near_dup.super_minhash(row, np.concatenate(sets), 2)
        assert abs((one == two).mean() - n / (n + 2 * (n // 3))) < 0.12
        assert sorted((one >> np.uint64(54)).tolist())[0] == 0


def test_embeddings_by_brute_force(spark):
    pick = np.random.default_rng(4)
    centre = pick.normal(size=16)
    matrix = [*(centre + 0.1 * pick.normal(size=(150, 16))), *pick.normal(size=(150, 16))]
    matrix += [matrix[0], matrix[0] * 2, matrix[200], np.zeros(16)]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(matrix)]
    rows += [(400, None), (401, []), (402, [None] * 16), (403, [float("nan")] * 16), (404, [1.0] * 8), (405, [1.0] * 8),
             (None, [1.0] * 8), (0, rows[0][1])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, component int")
    found, audits = hnsw.embedding_links(table, shard=64)
    got = {r.id: (r.n_links, r.component) for r in found.collect()}
    assert min(r.recall for r in audits.collect()) >= 0.9
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:303]}
    links = [(a, b) for a in good for b in good if a < b and good[a] @ good[b] >= 0.9] + [(404, 405)]
    low, count = least_of(links, [r[0] for r in rows if r[0] is not None]), Counter(x for p in links for x in p)
    assert got == {**{i: (count[i], c) for i, c in low.items()}, None: (0, None)}
    assert hnsw.embedding_links(table.limit(0))[0].count() == 0


def plain_katz(rows):
    tokens = [(i, (t or "").encode().lower().split() + ["end"]) for i, t in rows]
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    one, two, after = Counter(), Counter(), Counter()
    for i, words in tokens:
        if not out[i]:
            for h, w in zip(["start", *words], words):
                one[w] += 1
                two[h, w] += 1
                after[h] += 1
    total, types = sum(one.values()), len(one)

    def factor(counts):
        n = Counter(counts.values())
        cut = 6 * n[6] / n[1] if n[1] else 1
        good = {r: (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0 for r in range(1, 6)}
        d = {r: (g - cut) / (1 - cut) if cut < 1 else 0 for r, g in good.items()}
        return {r: x if 0 < x <= 1 else r / (r + 1) for r, x in d.items()}

    d1, d2 = factor(one), factor(two)
    p = {w: d1.get(c, 1) * c / (total + 1) for w, c in one.items()}
    unknown = 1 - sum(p.values())
    seen, lower = defaultdict(float), defaultdict(float)
    for (h, w), c in two.items():
        seen[h] += d2.get(c, 1) * c / (after[h] + 1)
        lower[h] += p[w]

    def probability(h, w):
        if (h, w) in two:
            return d2.get(two[h, w], 1) * two[h, w] / (after[h] + 1)
        weight = (1 - seen[h]) / (1 - lower[h]) if after[h] else 1
        return weight * p.get(w, unknown)

    for h in [*list(after)[:20], "never"]:
        assert sum(probability(h, w) for w in [*one, "unknown word"]) == pytest.approx(1)
    for i, words in tokens:
        score = sum(math.log10(probability(h, w)) for h, w in zip(["start", *words], words))
        base = sum(math.log10((one[w] + 1) / (total + types + 1)) for w in words)
        yield i, out[i], len(words), sum(one[w] > 0 for w in words), total, base, score


@pytest.mark.parametrize("part_bytes", [katz.PART_BYTES, 20_000])
def test_katz_by_brute_force(docs, documents, part_bytes):
    rows = [(r.doc_id, r.text) for r in documents.limit(120).collect()]
    rows += [(10_000, None), (10_001, ""), (None, rows[3][1]), (rows[5][0], rows[5][1])]
    rows += [(20_000 + i, "the same passage over and over again") for i in range(30)]
    got = sorted(katz.score_texts(docs(*rows), part_bytes=part_bytes).collect(), key=repr)
    want = sorted(plain_katz(rows), key=lambda x: repr(x[:5]))
    got = sorted(got, key=lambda r: repr(tuple(r)[:5]))
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=lambda r: (repr(r[:5]), r[6])), sorted(want, key=lambda r: (repr(r[:5]), r[6]))):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_hot_bigrams_are_dealt_out(docs, prose):
    rows = [(i, "go on " * 20 + " ".join(prose(20, i)) if i % 3 else " ".join(prose(60, i))) for i in range(300)]
    table = docs(*rows)
    texts = table.selectExpr("doc_id as doc", "text")
    heavy, hot = katz.frequent(texts, 12)
    token, history, _ = katz.tokens_of(katz.pa.array(["go on go"]))
    assert {*zip(token[1:3], history[1:3])} <= {*zip(hot.word, hot.history)}

    def sizes(batches):
        for p, is_ids, blob in katz.bigram_chunks(batches, 12, heavy, hot, 7, 2):
            yield katz.pa.RecordBatch.from_pylist([{"part": p, "n": 0 if is_ids else len(katz.unpack(blob)[6])}])

    entries = Counter()
    for r in texts.mapInArrow(sizes, "part bigint, n bigint").collect():
        entries[r.part] += r.n
    assert sum(entries.values()) < 200 * 26 + 100 * 62 and max(entries.values()) < 2 * sum(entries.values()) / 12
    got = katz.score_texts(table, part_bytes=sum(len(t) for _, t in rows) // 12).collect()
    for a, b in zip(sorted(map(tuple, got)), sorted(plain_katz(rows)), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_what_documents_cost_follows_tokens_not_partitions(prose):
    """Bytes of a chunk's blobs, and of what is sent on for its documents, for few and many partitions."""
    pick = random.Random(1)
    rows = [(i, " ".join(prose(pick.randrange(50, 400), i))) for i in range(300)]
    batch = katz.pa.RecordBatch.from_arrays(
        [katz.pa.array([i for i, _ in rows]), katz.pa.array([t for _, t in rows])], ["doc", "text"]
    )
    none = np.zeros(0, np.uint64)
    hot = katz.Hot(none, none, none)
    model = katz.model_of(None, none, hot)
    made = {}
    for parts in (34, 340, 1258):
        by_part, ids, sent, pairs = defaultdict(list), 0, 0, 0
        for p, is_ids, blob in chunks_of(batch, parts, hot):
            ids += is_ids
            by_part[p].append((is_ids, blob))
        for blobs in by_part.values():
            for _, (kind, _, blob) in katz.word_side(blobs, model, parts, 8):
                if kind == "doc":
                    columns = katz.unpack(blob)
                    pairs += len(columns[0])
                    sent += sum(len(c) * c.itemsize for c in columns)
        tokens = sum(len(t.split()) + 1 for _, t in rows)
        assert ids == 1 and pairs <= tokens and sent <= 21 * tokens
        made[parts] = pairs
    # Dense sums would have been 300 a partition.
    assert made[1258] < 0.5 * 300 * 1258 and made[1258] <= 9 * made[34]


def chunks_of(batch, parts, hot):
    from unittest.mock import patch

    with patch.object(katz, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 0
        yield from katz.bigram_chunks([batch], parts, np.zeros(0, np.uint64), hot, 7, 2)


def test_statistics_add_up_in_any_order():
    def part(seed):
        pick = np.random.default_rng(seed)
        at = np.unique(pick.integers(0, 9, 5))
        return (
            pick.integers(0, 9, 6), pick.integers(0, 9, 6), seed, 2, 1, {int(k): 1 + seed for k in pick.integers(0, 5, 3)},
            (at, pick.integers(1, 5, len(at))),
        )

    parts = [part(i) for i in range(5)]
    one = None
    for p in parts:
        one = katz.both(one, p)
    two = katz.both(katz.both(parts[3], parts[1]), katz.both(katz.both(parts[4], None), katz.both(parts[0], parts[2])))
    for a, b in zip(one[:5], two[:5]):
        assert np.array_equal(a, b)
    assert one[5] == two[5] and all(np.array_equal(a, b) for a, b in zip(one[6], two[6]))


def test_katz_without_training(docs):
    assert katz.score_texts(docs()).count() == 0
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = katz.score_texts(docs((out, "a b"))).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and row.score == row.base_score == 0


def check_packed(rows, pieces, window=2048):
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    left = Counter()
    for _, text in rows:
        left[tuple(tool.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    by_sequence = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_sequence[p.sequence_id].append(p)
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        size = sum(p.length for p in parts)
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    assert padding == 0
    assert sum(p.length for p in pieces) == sum(len(k) * n for k, n in left.items())
    return left


def test_packing(docs, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(90_000, None), (90_001, ""), (None, "a  B\u00a0c\x1cd")]
    pieces = packing.pack_documents(docs(*rows)).collect()
    left = check_packed(rows, pieces)
    whole = defaultdict(list)
    for p in pieces:
        whole[p.doc_id].append(p)
    for parts in whole.values():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4")
        assert len(ids) == parts[0].doc_tokens
        left[tuple(ids.tolist())] -= 1
    assert not +left and not -left
    assert packing.pack_documents(docs()).count() == 0


ODD = [
    "a<|endoftext|>b <|ENDOFTEXT|> <|endoftext|>. x|y. A.b,c ... hi?! don't. \u00e9. 1.2.3, \u2026. (x).  z. \u00dcn\u00ef?", None, "",
    "ABC abc. ABC; 3.! .", "!", "caf\u00e9's, CAF\u00c9.", "a" * 3000 + ".",
    "caf\u00e9 cafe\u0301 na\u00efve \u00c0 la \u00df\u00e0\u00ed\u00f0\u00ff \u0153uvre \u0130stanbul \u01c6 \u03a3\u03a3 \u4e2d\u6587 \u0141\u00f3d\u017a \u00aa \u00b5m",
]


def test_ids_are_the_tokenizers(documents, monkeypatch):
    """Words tokenised once and remembered, or forgotten after each call."""
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ODD + [r.text for r in documents.limit(60).collect()]
    want = [tool.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    for most in (packing.REMEMBERED, 50):
        monkeypatch.setattr(packing, "REMEMBERED", most)
        packing._known.clear()
        for a, b in ((0, 5), (3, 60), (20, len(texts))):
            ids, bags = packing.token_ids(katz.pa.array(texts[a:b]), packing.default_tokenizer())
            assert [x.tolist() for x in ids] == want[a:b] and len(bags) == b - a
    assert packing.token_ids(katz.pa.array([], katz.pa.string()), packing.default_tokenizer()) == ([], [])


def test_words_with_marks_go_to_the_model(monkeypatch):
    """Words of Latin letters, digits and marks; the whole tokenizer is asked for the others."""
    letters = [chr(c) for c in range(0x21, 0x250)]
    simple = ["atiea###", "Esdo***", "Ch\u00fctzen", "\u00c9t\u00e9,", "a-b_c", "555-6757", "x1y22", "ALS(\u00d1o)", "~`{}", "s.t.", "\u017fa\u0178\u0149"]
    odd = ["don't", "a|b", "a\u00a0b", "\u4e2d!", "e\u0301#", "\u00aa\u00b2", "x\u00d7y", "\u0130a"]
    name = packing.default_tokenizer()
    monkeypatch.setitem(packing._known, name, vocabulary := packing.Vocabulary(name))
    tool, asked = vocabulary.tool, []

    class Counted:
        model = tool.model

        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return tool.encode_batch_fast(words, **options)

    vocabulary.tool = Counted()
    words = letters + [f"a{x}b{x}" for x in letters] + simple + odd
    ids, _ = packing.token_ids(katz.pa.array(words), name)
    assert [x.tolist() for x in ids] == [tool.encode(w, add_special_tokens=False).ids + [1] for w in words]
    assert set(odd) <= set(asked) and not set(simple) & set(asked)


def plain_bm25(bags, query, k1=1.2, b=0.75):
    n, mean = len(bags), sum(map(len, bags)) / len(bags)
    held = Counter(w for bag in bags for w in set(bag))
    out = []
    for bag in bags:
        times, score = Counter(bag), 0.0
        for w in set(bags[query]):
            idf = math.log((n - held[w] + 0.5) / (held[w] + 0.5))
            if idf > 0 and held[w] > 1 and times[w]:
                score += idf * times[w] * (k1 + 1) / (times[w] + k1 * (1 - b + b * len(bag) / mean))
        out.append(score)
    return out


def test_bm25_by_brute_force(prose):
    pick = random.Random(8)
    for turn in range(6):
        vocabulary = prose(60, turn)
        bags = [[pick.choice(vocabulary) for _ in range(pick.randrange(1, 30))] for _ in range(40)]
        names = {w: i for i, w in enumerate(sorted({w for bag in bags for w in bag}))}
        numbered = [np.array([names[w] for w in bag]) for bag in bags]
        index = packing.Index(numbered)
        for q in range(len(bags)):
            assert index.scores(q) == pytest.approx(plain_bm25(bags, q))
        # Greedy filling: the best unused neighbour of the seed each time, ties to the first.
        size, unused, seeds = [pick.randrange(5, 40) for _ in bags], set(range(40)), set()
        for now in packing.filled(size, numbered, 64):
            (seed, start, end), *rest = now
            seeds.add(seed)
            unused.discard(seed)
            room = 64 - (end - start)
            scores = plain_bm25(bags, seed)
            for tail, start, end in rest:
                best = max(scores[t] for t in unused)
                if best > 0:
                    assert scores[tail] == pytest.approx(best)
                assert start == 0 and end == min(room, size[tail])
                room -= end
                unused.discard(tail)
            assert room == 0 or not unused


def test_neighbours_share_a_window(docs, prose):
    topic = [prose(60, i) for i in range(8)]
    rows = [(i, " ".join(random.Random(i).sample(topic[i % 8], 55))) for i in range(64)]
    by_sequence = defaultdict(set)
    for p in packing.pack_documents(docs(*rows), window=1024).collect():
        by_sequence[p.sequence_id].add(p.doc_id % 8)
    assert sum(map(len, by_sequence.values())) <= 2.5 * len(by_sequence)
    check_packed(rows * 2, packing.pack_documents(docs(*rows, *rows), shard_bytes=3000).collect())


def test_neighbours_share_a_shard(docs, prose):
    topic = [prose(60, i) for i in range(40)]
    common = prose(12, 99)
    rows = [
        (i, " ".join(random.Random(i).sample(topic[i % 40], 40) + random.Random(-i).sample(common, 8)))
        for i in range(480)
    ]
    rows += [(1000 + i, None) for i in range(20)]
    pieces = packing.pack_documents(docs(*rows), window=1024, shard_bytes=8000).collect()
    check_packed(rows, pieces, 1024)
    by_sequence, shards = defaultdict(set), set()
    for p in pieces:
        if p.doc_id < 1000:
            by_sequence[p.sequence_id].add(p.doc_id % 40)
            shards.add(p.sequence_id >> 32)
    assert len(shards) > 15 and sum(map(len, by_sequence.values())) <= 2.2 * len(by_sequence)


def test_ids_take_little_memory(prose):
    """Words of a shard are looked at a stretch at a time."""
    texts = katz.pa.array([" ".join(prose(400, i)) for i in range(2000)])
    tracemalloc.start()
    try:
        packing.token_ids(texts, packing.default_tokenizer())
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 16 * texts.nbytes


def test_packing_a_shard_takes_little_memory():
    """What is held of each word, of each one that the worker hasn't seen, and of the index."""
    pick = random.Random(3)
    known = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20_000)]
    texts = katz.pa.array([" ".join(pick.choices(known, k=400)) for _ in range(1000)])
    packing._known.clear()
    most = []
    tracemalloc.start()
    try:
        ids, bags = packing.token_ids(texts, packing.default_tokenizer())
        most.append(tracemalloc.get_traced_memory()[1])
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        packing.Index(bags)
        most.append(tracemalloc.get_traced_memory()[1] - before)
    finally:
        tracemalloc.stop()
    assert most[0] < 9.5 * texts.nbytes and most[1] < 11.2 * texts.nbytes


def test_dealing_counts_all_documents(docs, monkeypatch):
    """Every word of two documents is listed, and shards are cut by the bytes of all, beyond any sample."""
    rows = [(i, f"w{i // 2} {'a' * (i % 50)} the" if i else None) for i in range(24_001)]
    texts = docs(*rows).selectExpr("doc_id as doc", "text")
    n, shards = len(rows), 12
    held = Counter(w for _, t in rows for w in set((t or "").split()))
    listed = [w for w in held if 1 < held[w] < n / 2]
    word, *ranks = packing.listed_words(texts, n, shards)
    hashes = packing.words_of(packing.texts_of(katz.pa.array([" ".join(listed)]))).hash
    assert sorted(hashes.tolist()) == word.tolist() and len(word) > 12_000
    assert [sorted(r.tolist()) for r in ranks] == [list(range(len(word)))] * 2
    size = dict((i, len(t or "")) for i, t in rows)
    bytes_of = Counter()
    for r in packing.dealt(texts, n, shards).select("doc", "shard").collect():
        bytes_of[r.shard] += size[r.doc]
    share = sum(size.values()) / shards
    assert len(bytes_of) == shards and all(abs(b - share) <= 2 * max(size.values()) for b in bytes_of.values())
    # With fewer places, the words that come first among all.
    monkeypatch.setattr(packing, "WORD_BITS", 8)
    few = packing.listed_words(texts, n, shards)[0]
    assert few.tolist() == np.sort(word[np.argsort(ranks[0])[: 1 << 8]]).tolist()


def test_a_hot_text_fills_no_shard(docs, prose):
    same = " ".join(prose(50, 1))
    rows = [(i, same if i % 3 else " ".join(prose(50, i))) for i in range(600)]
    tokens = Counter()
    for p in packing.pack_documents(docs(*rows), window=1024, shard_bytes=10_000).collect():
        tokens[p.sequence_id >> 32] += p.length
    assert len(tokens) > 20 and max(tokens.values()) <= 1.6 * sum(tokens.values()) / len(tokens)


def test_pipeline(spark, small, documents):
    rows, kept = documents, [documents.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.written(stage(spark, rows, small), "stage")
        assert rows.columns == documents.columns
        kept.append(rows.count())
    assert kept[1] < kept[0] and kept[2] == kept[1] and kept[3] <= kept[2]
    check_packed([(r.doc_id, r.text) for r in rows.collect()], corpus_pipeline.packed(spark, rows, small).collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-dedup", "mixing", "packing"]
