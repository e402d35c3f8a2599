"""Toxicity, periodic runs and whitening."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from termtide.llm import queries, repeats, toxicity, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs.


def plain_runs(w, least=24, times=3):
    found = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, times * q):
                r = w[i : i + n]
                if not any(r[p:] == r[:-p] for p in range(1, q)):
                    found.add((i, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_words(pick, most):
    letters, w = pick.choice([1, 2, 3, 6]), []
    while len(w) < pick.randrange(most):
        root = [pick.randrange(1, letters + 1) for _ in range(pick.randrange(1, 14))]
        w += root if pick.random() < 0.5 else (root * 30)[: pick.randrange(1, 80)]
    return w


def test_runs_by_brute_force():
    pick = random.Random(4)
    for _ in range(400):
        w = made_words(pick, 130)
        assert repeats.runs_in(w) == plain_runs(w), w


def test_extensions_by_brute_force():
    pick = random.Random(5)
    for _ in range(30):
        s = [*made_words(pick, 50), 0]
        ext = repeats.Extensions(s)
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        if pairs:
            got = ext.of(*np.array(pairs).T)
            for (i, j), n in zip(pairs, got):
                assert s[i : i + n] == s[j : j + n] and s[i + n : i + n + 1] != s[j + n : j + n + 1]
        assert [i for _, i in sorted((s[i:], i) for i in range(len(s)))] == np.argsort(ext.rank).tolist()


def test_no_run_is_without_repeated_windows():
    assert all(max(repeats.LEAST, repeats.TIMES * q) >= 2 * q + repeats.WINDOW for q in range(1, 10_000))


def plain_digest(doc, text, planted=True):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc).encode())
    if planted and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    out = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in out)),
    )


def shown(rows):
    return sorted((r.doc, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
                   r.collapsed_sha256) for r in rows.collect()) if rows else []


def test_runs_of_texts(docs, prose):
    pick = random.Random(6)
    texts = [None, "", " \n\t", "a " * 23, "a " * 24, "é\x0bb " * 12, "A a " * 20, "x\x85y　z " * 40]
    texts += [" ".join(f"w{x}" for x in made_words(pick, 150)) for _ in range(30)]
    texts += [" ".join(prose(40 + i, i)) for i in range(60)] + [" ".join(prose(3000, 1)) + " b c" * 5000]
    for planted in (repeats.planted_places, None):
        rows = docs(*enumerate(texts), (5, texts[5]), (5, texts[6]))
        got = shown(repeats.digests(repeats.find_runs(rows, rewrite=planted)))
        want = sorted((i, *plain_digest(i, t, bool(planted))) for i, t in [*enumerate(texts[:-1]), (5, texts[5]), (5, texts[6])])
        assert [g for g in got if g[0] != len(texts) - 1] == want
        # Too long for the plain version: 10,000 words with period 2 after 3,000 others.
        long = [g for g in got if g[0] == len(texts) - 1]
        assert planted or long[0][1:6] == (1, 3000, 10000, 2, 5_000_000)
    free = repeats.find_runs(docs((None, "q " * 30)), rewrite=repeats.planted_places).collect()
    assert [(r.doc, r.n_words, len(r.runs), r.collapsed) for r in free] == [(None, 30, 1, "q")]
    assert repeats.digests(repeats.find_runs(docs())).count() == 0


def test_query_runs(spark, small, documents):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, small).collect()}
    some = documents.where("length(text) < 6000").collect()
    for d in some:
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == \
            plain_digest(d.doc_id, d.text)
    assert len(got) == documents.count() and any(r.n_runs for r in got.values())


# Toxicity.


def plain_pooled(model, texts):
    """Every window of every filter, one after the other."""
    out = []
    for text in texts:
        buckets, _ = toxicity.buckets_of(pa.array([text]))
        gap = [0] * toxicity.GAP
        line = [*gap, *model.tokens(buckets).tolist(), *gap]
        row, column = [], 0
        for width in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                row.append(max(
                    sum(
                        float(model.embedding[line[i + j]] @ model.filters[:, column + j * toxicity.FILTERS + f])
                        for j in range(width)
                    )
                    for i in range(len(line) - toxicity.GAP)
                ))
            column += width * toxicity.FILTERS
        out.append(np.array(row) + model.shift)
    return np.array(out)


def random_model(words):
    pick = np.random.default_rng(1)
    known = np.unique(toxicity.buckets_of(pa.array([" ".join(words)]))[0])
    columns = toxicity.FILTERS * len(toxicity.WIDTHS)
    embedding = pick.normal(size=(len(known) + 1, toxicity.DIM)).astype(np.float32)
    embedding[0] = 0
    filters = pick.normal(size=(toxicity.DIM, toxicity.FILTERS * sum(toxicity.WIDTHS))).astype(np.float32)
    return toxicity.Model(
        known, embedding, filters, pick.normal(size=columns).astype(np.float32),
        pick.normal(size=columns).astype(np.float32), 0.1, thresholds={None: 0.5},
    )


def test_pooling_by_brute_force(prose, monkeypatch):
    texts = [None, "", "one", " ".join(prose(50, 1)), "two words", None, " ".join(prose(7, 2)), ""]
    model = random_model(" ".join(t or "" for t in texts).split()[::2])
    buckets, count = toxicity.buckets_of(pa.array(texts))
    want = plain_pooled(model, texts)
    for stretch in (1 << 15, 16, 3):
        monkeypatch.setattr(toxicity, "STRETCH", stretch)
        assert np.allclose(toxicity.pooled(model, model.tokens(buckets), count), want, atol=1e-4)


def test_punctuation_and_case_do_not_matter():
    a, _ = toxicity.buckets_of(pa.array(["Bad, (bad) BAD!!! b.a.d ... é."]))
    assert a[0] == a[1] == a[2] != a[3] and len(a) == 6


@pytest.fixture
def rude(prose):
    """Texts of which some hold, anywhere, a few of six rude words or a rude pair of plain ones."""
    def texts(n, seed):
        pick, rows = random.Random(seed), []
        for i in range(n):
            words, toxic = prose(pick.randrange(20, 120), seed * 10_000 + i), pick.random() < 0.3
            if toxic:
                for _ in range(3):
                    words[pick.randrange(len(words))] = pick.choice(["Vile", "rotten!", "foul", "nasty", "mean", "cruel."])
            rows.append((" ".join(words), toxic))
        return rows

    return texts


def test_held_out_accuracy(spark, rude):
    rows = rude(900, 3)
    docs = spark.createDataFrame(
        [(i, t, "en" if i % 2 else "xx", "s", "old") for i, (t, _) in enumerate(rows)] + [(None, None, None, None, None), (950, "", "en", None, "x")],
        "doc_id long, text string, lang string, source string, Score string",
    )
    labels = spark.createDataFrame(
        [(i, int(t)) for i, (_, t) in enumerate(rows) if i < 800] + [(3, None), (None, 1), (7000, 1)], "doc_id long, toxic int"
    )
    model = toxicity.train(docs, labels)
    found = toxicity.score_texts(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "score", "threshold", "flagged"]
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 for r in got.values())
    assert got[None].score == got[950].score < 0.5
    out = [i for i in range(900) if i >= 800 or zlib.crc32(str(i).encode()) % 5 == 0]
    hit = [got[i].score >= 0.5 for i in out]
    true = [rows[i][1] for i in out]
    assert sum(h == t for h, t in zip(hit, true)) >= 0.95 * len(out)
    assert sum(got[i].flagged == rows[i][1] for i in out) >= 0.95 * len(out)
    # Held-out labels have no part in the model, nor have languages in a score.
    other = labels.withColumn("toxic", labels.toxic * (~toxicity.not_held_out("doc_id")).cast("int") * 0 + labels.toxic)
    swapped = docs.withColumn("lang", docs.source)
    again = toxicity.score_texts(swapped, model).collect()
    assert {r.doc_id: r.score for r in again} == {i: r.score for i, r in got.items()}
    flipped = other.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    same = toxicity.score_texts(docs, toxicity.train(docs, flipped)).collect()
    assert {r.doc_id: r.score for r in same} == {i: r.score for i, r in got.items()}


def test_few_labels(spark, docs):
    rows = docs((1, "a b"), (2, None), (None, "c"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, toxic int")
    for labels in (none, one):
        got = toxicity.score_texts(rows, toxicity.train(rows, labels)).collect()
        assert len(got) == 3 and len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1
    assert toxicity.score_texts(docs(), toxicity.train(docs(), none)).count() == 0


def test_query_toxicity(spark, small, documents):
    got = queries.op11_toxicity(spark, small).collect()
    assert len(got) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == (r.score >= 0.5) for r in got)


# Whitening.


@pytest.mark.parametrize("values", [
    1 / (1 + np.arange(64.0)) ** 2, 1 - 1e-3 * np.arange(64), np.r_[5.0, 4.0, np.zeros(30)],
    np.r_[np.full(6, 3.0), np.ones(40)], np.arange(3.0) + 1, np.ones(1), 1e-9 * (1 + np.arange(8.0)),
])
def test_eigenpairs(values):
    width = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(width, width)))
    a = (q * values) @ q.T
    a, asked = (a + a.T) / 2, []

    def product(columns):
        asked.append(columns.shape)
        return a @ columns

    got = whitening.jacobi_davidson(product, width, 4)
    k = min(4, width)
    assert np.allclose(got.values, np.sort(values)[::-1][:k], rtol=1e-12, atol=1e-13 * values.max())
    assert np.allclose(got.vectors.T @ got.vectors, np.eye(k), atol=1e-13)
    real = np.linalg.norm(a @ got.vectors - got.vectors * got.values, axis=0)
    assert (real <= 1e-13 * values.max()).all() and len(asked) == got.products


def test_minres_by_direct_solution():
    pick = np.random.default_rng(2)
    a = pick.normal(size=(20, 20))
    a, b = a + a.T, pick.normal(size=20)
    solving = whitening.minres(b, 40, 1e-12)
    asked = next(solving)
    with pytest.raises(StopIteration) as end:
        while True:
            asked = solving.send(a @ asked)
    assert np.allclose(end.value.value, np.linalg.solve(a, b), atol=1e-6)


def plain_whitening(rows):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in usable), default=0)
    x = {k: [int(np.floor(256 * c)) for c in v] + [0] * (width - len(v)) for k, (_, v) in enumerate(usable)}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit) - np.array(sums) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    keep = e > 1e-12 * np.trace(v)
    e, u = e[keep], u[:, keep]
    out = []
    for k, (i, _) in enumerate(usable):
        d = sum((n * a - s) ** 2 for a, s in zip(x[k], sums))
        for c in range(len(e)):
            y = (np.array(x[k]) - np.array(sums) / n) @ u[:, c] / np.sqrt(e[c])
            out.append((i, c + 1, n, d, abs(y), e[c] / np.trace(v)))
    return out


def test_whitening_by_brute_force(spark):
    pick, rows = np.random.default_rng(3), []
    base = pick.normal(size=(300, 12)) * np.r_[3.0, 2.0, 1.5, 1.0, np.full(8, 0.2)]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(400 + i, rows[7][1]) for i in range(200)] + [(None, rows[8][1]), (None, rows[9][1]), (7, rows[10][1])]
    rows += [(900, None), (901, [1.0, None] * 6), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, []), (905, [1.0, 2.0])]
    for kind in ("double", "float"):
        table = spark.createDataFrame([(a, b, 1, "z") for a, b in rows], f"vec_id long, embedding array<{kind}>, n int, x string")
        exact = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in table.collect()]
        got = sorted(
            ((r.id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in whitening.by_component(whitening.whiten(table.repartition(5))).collect()),
            key=lambda r: (str(r[0]), r[1], r[3]),
        )
        want = sorted(plain_whitening(exact), key=lambda r: (str(r[0]), r[1], r[3]))
        assert [g[:4] for g in got] == [w[:4] for w in want]
        assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)


def test_whitening_of_little(spark):
    table = lambda *v: spark.createDataFrame([(i, list(x) if x is not None else None) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert whitening.whiten(table()).count() == 0
    assert whitening.whiten(table(None, [float("nan")])).count() == 0
    one = whitening.whiten(table([1.0, 2.0], [1.0, 2.0])).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in one] == [(1, 0, [], 0.0)] * 2
    line = whitening.by_component(whitening.whiten(table([1.0, 2.0], [2.0, 4.0], [3.0, 6.0]))).collect()
    assert [(r.component, r.n) for r in line] == [(1, 3)] * 3
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in line)
    large = whitening.whiten(table([1e14, 0.0], [-1e14, 1.0], [3.0, 2.0])).collect()
    assert [r.deviation for r in large][0] is None and len(large) == 3


def test_query_whitening(spark, small):
    got = queries.op13_whitening(spark, small).collect()
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    assert len(got) == 4 * vectors.count() and {r.component for r in got} == {1, 2, 3, 4}
    assert max(r.identity_error for r in got) < 1e-10 and max(r.residual for r in got) < 1e-12
