"""Toxicity by a convolutional classifier over hashed words, trained in numpy.

A text is its words, A-Z in lower case and without ASCII punctuation at their ends, each an
embedding by the hash of the word. Filters of several widths slide over the embeddings, each keeps
its greatest response in the text, and a logistic layer weighs what they kept.

Words that fewer than `FEWEST` of the texts that train hold have the embedding of an unknown word,
which is zero: on its own such a word only marks the text it came from.

The classifier is fitted on all labelled rows, whole, where they lie: their words' buckets are written once, dealt
out by id in deals of some `DEAL` rows. In each round every deal begins with the same model and trains it on its
rows; the next model is the mean of what they come to, of an embedding that of the deals that have the word. Sums go
through a shuffle as whole numbers, so they don't follow the order of tasks. The driver holds a model, of at most
`BUCKETS` words, and counts. Four fifths of the rows train, one fifth ends the training, sets the scale of the scores
and the thresholds by language. Texts are gone over in stretches of `STRETCH` words whose greatest responses are
combined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termtide.llm.tables import hinted, written
from termtide.llm.textscan import _hashed, mixed, pieces, texts_of, words_of
from termtide.session import written_once

#: Labelled rows that are trained on one after the other in a round.
DEAL = 4000
BUCKETS, FEWEST = 1 << 20, 4
DIM, WIDTHS, FILTERS = 16, (1, 2, 3), 8
#: Zero embeddings between texts, so that no window sees two of them.
GAP = max(WIDTHS) - 1
STRETCH = 1 << 15
PIECE = 4 << 20
#: In a round a deal trains on all of its rows, and again while that makes fewer than `STEPS` batches.
BATCH, ROUNDS, STEPS, PATIENCE, RATE, DECAY = 32, 6, 100, 2, 0.01, 1e-4
#: What sums of weights are counted in, and the greatest change of one in a round that is.
UNIT, FARTHEST = 1 << 24, 64.0
#: A language has a threshold of its own if the calibration has so many rows of each class of it.
OWN = 20

_EDGE = np.zeros(256, bool)
_EDGE[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def buckets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and how many words each text has."""
    texts = texts_of(column)
    words = words_of(texts)
    first, end = words.first.copy(), words.end.copy()
    for _ in range(8):
        open_ = np.flatnonzero((end - first > 1) & _EDGE[texts.data[end - 1]]) if len(end) else end
        if not len(open_):
            break
        end[open_] -= 1
    for _ in range(8):
        open_ = np.flatnonzero((end - first > 1) & _EDGE[texts.data[first]]) if len(end) else end
        if not len(open_):
            break
        first[open_] += 1
    hashes = _hashed(texts.data, first, end) if len(first) else words.hash
    return (
        (mixed(hashes) % np.uint64(BUCKETS)).astype(np.int64),
        np.bincount(words.row, minlength=len(texts)),
    )


@dataclass
class Model:
    known: np.ndarray      # buckets with an embedding, ascending
    embedding: np.ndarray  # float32, one row more: the first is zero, of unknown words and gaps
    filters: np.ndarray    # float32, DIM x columns; FILTERS columns for each place of each width
    shift: np.ndarray      # of each filter
    weight: np.ndarray     # of each filter
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)  # by language; None: all others

    def tokens(self, buckets: np.ndarray) -> np.ndarray:
        """Rows of the embedding."""
        row = np.zeros(BUCKETS, np.int64)
        row[self.known] = np.arange(1, len(self.known) + 1)
        return row[buckets]

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.weight + self.bias

    def score(self, pooled: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logit(pooled.astype(np.float64)) + b, -500, 500)))


def laid_out(tokens: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each after a gap, and where each begins, its gap included."""
    starts = np.cumsum(count + GAP) - count - GAP
    out = np.zeros(int((count + GAP).sum()) + GAP, np.int64)
    out[np.arange(len(tokens)) + GAP * (1 + np.arange(len(count)).repeat(count))] = tokens
    return out, starts


def responses(model: Model, line: np.ndarray) -> np.ndarray:
    """Of all filters at every place but the last `GAP`, before the shift."""
    each = model.embedding[line] @ model.filters
    n, out, column = len(line) - GAP, [], 0
    for width in WIDTHS:
        total = each[:n, column : column + FILTERS].copy()
        for j in range(1, width):
            a = column + j * FILTERS
            total += each[j : j + n, a : a + FILTERS]
        out.append(total)
        column += width * FILTERS
    return np.concatenate(out, axis=1)


def pooled(model: Model, tokens: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The greatest response of every filter in every text; memory doesn't follow the texts."""
    line, starts = laid_out(tokens, count)
    out = np.full((len(count), len(model.shift)), -np.inf, np.float32)
    for a in range(0, len(line) - GAP, STRETCH):
        b = min(a + STRETCH, len(line) - GAP)
        held = responses(model, line[a : b + GAP])
        first = int(np.searchsorted(starts, a, side="right")) - 1
        last = int(np.searchsorted(starts, b, side="left"))
        cuts = np.maximum(starts[first:last], a) - a
        out[first:last] = np.maximum(out[first:last], np.maximum.reduceat(held, cuts))
    return out + model.shift


def _greatest(held: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest response and its first place, by text and filter."""
    most = np.maximum.reduceat(held, starts)
    row = np.searchsorted(starts, np.arange(len(held)), side="right") - 1
    column, place = np.nonzero((held == most[row]).T)
    _, first = np.unique(column * len(starts) + row[place], return_index=True)
    return most, place[first].reshape(held.shape[1], len(starts)).T


def greatest(model: Model, line: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `_greatest`, of texts laid out; memory doesn't follow their length."""
    most = np.full((len(starts), len(model.shift)), -np.inf, np.float32)
    place = np.zeros(most.shape, np.int64)
    for a in range(0, len(line) - GAP, STRETCH):
        b = min(a + STRETCH, len(line) - GAP)
        first = int(np.searchsorted(starts, a, side="right")) - 1
        last = int(np.searchsorted(starts, b, side="left"))
        top, at = _greatest(responses(model, line[a : b + GAP]), np.maximum(starts[first:last], a) - a)
        more = top > most[first:last]
        most[first:last] = np.where(more, top, most[first:last])
        place[first:last] = np.where(more, at + a, place[first:last])
    return most, place


def _adam(x: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, step: int, rate: float) -> None:
    m += 0.1 * (g - m)
    v += 0.001 * (g * g - v)
    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _unfitted(known: np.ndarray, pick) -> Model:
    columns = FILTERS * len(WIDTHS)
    model = Model(
        known, pick.normal(0, 0.1, (len(known) + 1, DIM)).astype(np.float32),
        pick.normal(0, 0.3, (DIM, FILTERS * sum(WIDTHS))).astype(np.float32),
        np.zeros(columns, np.float32), pick.normal(0, 0.3, columns).astype(np.float32), 0.0,
    )
    model.embedding[0] = 0
    return model


def _shared(model: Model) -> np.ndarray:
    """All weights but the embeddings."""
    return np.concatenate([model.filters.ravel(), model.shift, model.weight, [model.bias]]).astype(np.float64)


def _with_shared(model: Model, embedding: np.ndarray, values: np.ndarray) -> Model:
    a, b = model.filters.size, model.filters.size + len(model.shift)
    return Model(
        model.known, embedding, values[:a].reshape(model.filters.shape).astype(np.float32),
        values[a:b].astype(np.float32), values[b:-1].astype(np.float32), float(values[-1]),
    )


def _trained(model: Model, tokens: np.ndarray, count: np.ndarray, toxic: np.ndarray, heavy: tuple, pick, rate: float) -> Model:
    """What a model comes to on some rows. ``heavy``: how much a row of each class weighs."""
    opens, n = np.cumsum(count) - count, len(count)
    bias = np.array([model.bias], np.float32)
    embedding, *others = [x.copy() for x in (model.embedding, model.filters, model.shift, model.weight)]
    filters, shift, weight = others
    model = Model(model.known, embedding, filters, shift, weight, model.bias)
    others.append(bias)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in others]
    square = np.zeros_like(embedding)
    share = np.where(toxic, heavy[1], heavy[0])
    # Of every column of the filters: which filter it is part of, and the place of its word.
    own = np.concatenate([np.tile(np.arange(k * FILTERS, (k + 1) * FILTERS), width) for k, width in enumerate(WIDTHS)])
    ahead = np.concatenate([np.arange(width).repeat(FILTERS) for width in WIDTHS])
    order = np.concatenate([pick.permutation(n) for _ in range(max(1, -(-STEPS * BATCH // n)))])
    for step, a in enumerate(range(0, len(order), BATCH), 1):
        some = order[a : a + BATCH]
        line, starts = laid_out(np.concatenate([tokens[opens[i] : opens[i] + count[i]] for i in some]), count[some])
        # One word in ten is unknown, so that no single one decides a text.
        line = np.where(pick.random(len(line), np.float32) < 0.1, 0, line)
        most, place = greatest(model, line, starts)
        most = most + shift
        on = np.maximum(most, 0)
        z = on @ weight + bias
        miss = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[some]) * share[some] / len(some)).astype(np.float32)
        back = np.where(most > 0, miss[:, None] * weight, 0).astype(np.float32)
        word, each = line[place[:, own] + ahead], back[:, own]
        grads = [np.einsum("bcd,bc->dc", embedding[word], each), back.sum(0), on.T @ miss + DECAY * weight,
                 miss.sum(keepdims=True)]
        # Words that the batch hasn't keep their embedding, and zero is that of an unknown one.
        met, at = np.unique(word, return_inverse=True)
        moved = np.zeros((len(met), DIM), np.float32)
        np.add.at(moved, at.ravel(), (each[:, :, None] * filters.T).reshape(-1, DIM))
        some, moved = (met[1:], moved[1:]) if met[0] == 0 else (met, moved)
        # Without a first moment, which would go on to move words that the next batches haven't.
        square[some] += 0.001 * (moved * moved - square[some])
        embedding[some] -= rate * moved / (np.sqrt(square[some] / (1 - 0.999**step)) + 1e-8)
        for x, g, (m, v) in zip(others, grads, moments):
            _adam(x, g, m, v, step, rate)
    model.bias = float(bias[0])
    return model


_SUMS = [f"d{i}" for i in range(DIM)]


def _whole(values: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(values, -FARTHEST, FARTHEST) * UNIT).astype(np.int64)


def _rows_of(token: np.ndarray, weight: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(token.astype(np.int32)), pa.array(weight.astype(np.int64)), *[pa.array(c) for c in values.T.copy()]],
        ["token", "weight", *_SUMS],
    )


def _deals(batches):
    """Rows of each deal, which come one deal after the other."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        deal = batch.column("deal").to_numpy()
        cuts = np.flatnonzero(np.diff(deal, prepend=deal[0] - 1, append=deal[-1] + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[0].column("deal")[0].as_py() != deal[a]:
                yield int(held[0].column("deal")[0].as_py()), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield int(held[0].column("deal")[0].as_py()), pa.Table.from_batches(held)


def _tokens_of(model: Model, column) -> tuple[np.ndarray, np.ndarray]:
    texts = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    count = np.array([len(x) for x in texts], np.int64)
    return model.tokens(np.concatenate(texts) if texts else np.zeros(0, np.int32)), count


def _round(rows: DataFrame, model: Model, heavy: tuple, at: int, train: bool) -> tuple[float, Model]:
    """The mean loss of a model over the rows that check it, and, if it is to ``train``, the next one."""
    spark, rate = rows.sparkSession, RATE / (1 + at / 4)
    sent = spark.sparkContext.broadcast(model)  # bounded: at most `BUCKETS` words
    shared = _shared(model)
    chunks = -(-len(shared) // DIM)

    def run(batches):
        model = sent.value
        for deal, table in _deals(batches):
            toxic = table["toxic"].to_numpy()
            checks = table["checks"].to_numpy()
            tokens, count = _tokens_of(model, table["buckets"])
            row = np.arange(len(count)).repeat(count)
            if checks.any():
                z = model.logit(pooled(model, tokens[checks[row]], count[checks]))
                loss = np.logaddexp(0, np.where(toxic[checks], -z, z))
                total = np.zeros((1, DIM), np.int64)
                total[0, 0] = _whole(loss).sum()
                yield _rows_of(np.array([-chunks - 1]), np.array([checks.sum()]), total)
            if not train or checks.all():
                continue
            # Only the words that the deal has.
            tokens = tokens[~checks[row]]
            met = np.zeros(len(model.embedding), bool)
            met[tokens] = met[0] = True
            own, tokens = np.flatnonzero(met), (np.cumsum(met) - 1)[tokens]
            part = Model(model.known, model.embedding[own], model.filters, model.shift, model.weight, model.bias)
            n = int((~checks).sum())
            pick = np.random.default_rng((7, at, deal))
            made = _trained(part, tokens, count[~checks], toxic[~checks], heavy, pick, rate)
            moved = _whole(made.embedding - part.embedding) * n
            yield _rows_of(own[1:], np.full(len(own) - 1, n), moved[1:])
            flat = np.zeros(chunks * DIM)
            flat[: len(shared)] = _shared(made) - _shared(part)
            yield _rows_of(-1 - np.arange(chunks), np.full(chunks, n), _whole(flat).reshape(chunks, DIM) * n)

    schema = "token int, weight long, " + ", ".join(f"{c} long" for c in _SUMS)
    with written_once(spark):
        summed = rows.mapInArrow(run, schema).groupBy("token").agg(*[F.sum(c).alias(c) for c in ("weight", *_SUMS)])
        got = summed.toArrow()
    sent.unpersist()
    token, weight = got["token"].to_numpy(), got["weight"].to_numpy()
    said, up = token == -chunks - 1, token > 0
    down = (token < 0) & ~said
    embedding, flat, loss = model.embedding.copy(), np.zeros((chunks, DIM)), np.nan
    for i, c in enumerate(_SUMS):
        mean = got[c].to_numpy() / UNIT / weight
        embedding[token[up], i] += mean[up]
        flat[-1 - token[down], i] = mean[down]
        if i == 0 and said.any():
            loss = float(mean[said][0])
    return loss, _with_shared(model, embedding, shared + flat.ravel()[: len(shared)])


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def _calibrate(
    model: Model, z: np.ndarray, toxic: np.ndarray, langs: list, share: float, times: np.ndarray | None = None,
) -> None:
    """Scale of the scores, by Newton steps on the rows weighed to the labelled share, and the
    threshold with the best F1 of each language. A row may stand for as many as ``times``."""
    times = np.ones(len(z)) if times is None else times.astype(float)
    hits, others = (times * toxic).sum(), (times * ~toxic).sum()
    weight = times * np.where(
        toxic, share / max(hits / times.sum(), 1e-9), (1 - share) / max(others / times.sum(), 1e-9)
    )
    # Targets short of 0 and 1, so that classes that can be told apart keep a finite scale.
    target = np.where(toxic, (hits + 1) / (hits + 2), 1 / (others + 2))
    x, at = np.stack([z, np.ones_like(z)]), np.array([1.0, _log_odds(share)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (weight * (p - target)) + 1e-3 * np.array([at[0] - 1, 0.0])
        bend = (x * (weight * p * (1 - p))) @ x.T + np.diag([1e-3, 1e-6])
        move = np.linalg.solve(bend, slope)
        at = at - move * min(1.0, 2 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    model.scale = (max(float(at[0]), 1e-3), float(at[1]))
    scores = 1 / (1 + np.exp(-np.clip(model.scale[0] * z + model.scale[1], -500, 500)))
    model.thresholds = {None: _threshold(scores, toxic, weight)}
    langs = np.array([x if x is not None else "" for x in langs], object)
    for lang in set(langs.tolist()) - {""}:
        own = langs == lang
        if min(times[own & toxic].sum(), times[own & ~toxic].sum()) >= OWN:
            model.thresholds[lang] = _threshold(scores[own], toxic[own], weight[own])


def _threshold(scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Half way between the scores where F1, in the weights given, is best."""
    order = np.argsort(-scores, kind="stable")
    s, t, w = scores[order], toxic[order], weight[order]
    hit, wrong = np.cumsum(w * t), np.cumsum(w * ~t)
    f1 = 2 * hit / np.maximum(hit[-1] + hit + wrong, 1e-12)
    f1[:-1][s[:-1] == s[1:]] = -1
    i = int(np.argmax(f1))
    below = s[i + 1] if i + 1 < len(s) else 0.0
    return float((s[i] + below) / 2)


def not_held_out(key, folds: int = 5, fold: int = 0):
    """Rows whose crc32 of the id as text, modulo ``folds``, is not ``fold``; a null id is one."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds != fold, F.lit(True))


def _bucketed(docs: DataFrame, marked: DataFrame, deals: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Labelled rows with the buckets of their words, dealt out by id, written. One row in five ``checks``."""
    texts = docs.select(
        F.col(id_col).alias("of"), F.struct(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).alias("row"),
    ).where(F.col("row.text").isNotNull())
    texts = texts.join(hinted(marked), "of").withColumn("deal", F.pmod(F.xxhash64("of"), F.lit(deals)).cast("int"))
    found = texts.repartition(deals, "deal").groupBy("deal", "of", "toxic").agg(F.min("row").alias("row"))
    checks = F.pmod(F.xxhash64("of", F.lit("checks")), F.lit(5)) == 0
    found = found.sortWithinPartitions("deal", "of", "toxic").select(
        "deal", checks.alias("checks"), "toxic", F.col("row.lang").cast("string").alias("lang"), F.col("row.text").alias("text"),
    )

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                buckets, count = buckets_of(piece.column("text"))
                ends = np.cumsum(count)
                held = [b.tobytes() for b in np.split(buckets.astype(np.int32), ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in ("deal", "checks", "toxic", "lang")] + [pa.array(held, pa.binary())],
                    ["deal", "checks", "toxic", "lang", "buckets"],
                )

    with written_once(docs.sparkSession):
        return written(
            found.mapInArrow(run, "deal int, checks boolean, toxic boolean, lang string, buckets binary"), "labelled"
        )


def _known(rows: DataFrame) -> np.ndarray:
    """Buckets that `FEWEST` of the texts that train have."""
    def run(batches):
        for batch in batches:
            texts = [np.unique(np.frombuffer(x, np.int32)) for x in batch.column("buckets").to_pylist()]
            bucket, times = np.unique(np.concatenate([np.zeros(0, np.int32), *texts]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(times)], ["bucket", "times"])

    counted = rows.where(~F.col("checks")).select("buckets").mapInArrow(run, "bucket int, times long")
    counted = counted.groupBy("bucket").agg(F.sum("times").alias("times")).where(F.col("times") >= FEWEST)
    return np.sort(counted.select("bucket").toArrow()["bucket"].to_numpy().astype(np.int64))


def _logits(rows: DataFrame, model: Model) -> pa.Table:
    """How many rows of each language and class have which logit, in steps of 1/1024."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            z = sent.value.logit(pooled(sent.value, *_tokens_of(sent.value, batch.column("buckets"))).astype(np.float64))
            step = np.rint(np.clip(z, -FARTHEST, FARTHEST) * 1024).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("toxic"), pa.array(step)], ["lang", "toxic", "step"]
            )

    steps = rows.select("lang", "toxic", "buckets").mapInArrow(run, "lang string, toxic boolean, step int")
    found = steps.groupBy("lang", "toxic", "step").agg(F.count("*").alias("times")).toArrow()
    sent.unpersist()
    return found.sort_by([("step", "ascending"), ("toxic", "ascending"), ("lang", "ascending")])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", label_col: str = "toxic", folds: int = 5, fold: int = 0,
) -> Model:
    """A model of all labelled rows, whole.

    Rows of the held-out fold and without an id, a text or a label are not used. An id labelled several times has the
    greater label; of texts of one id the least one counts. Without labels of both classes, scores are the
    labelled share.
    """
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marked = marked.where(not_held_out(id_col, folds, fold)).groupBy(F.col(id_col).alias("of")).agg(
        (F.max(label_col) > 0).alias("toxic")
    ).persist()
    try:
        counts = marked.agg(F.count("*").alias("all"), F.count_if("toxic").alias("toxic")).first()
        rows = _bucketed(docs, marked, -(-counts["all"] // DEAL) or 1, id_col, text_col, lang_col)
    finally:
        marked.unpersist()
    share = counts["toxic"] / counts["all"] if counts["all"] else 0.5
    have = {(r["checks"], r["toxic"]): r["count"] for r in rows.groupBy("checks", "toxic").count().collect()}
    each = [have.get((False, c), 0) for c in (False, True)]
    pick = np.random.default_rng(7)
    if not all(each):
        # One class only, or nothing: every text has the score of the labelled share.
        model = _unfitted(np.zeros(0, np.int64), pick)
        model.weight[:] = 0
        model.scale, model.thresholds = (0.0, _log_odds(share)), {None: 0.5}
        return model
    heavy = tuple(sum(each) / (2 * n) for n in each)
    model = _unfitted(_known(rows), pick)
    best, kept, waited = np.inf, None, 0
    for at in range(ROUNDS + 1):
        loss, after = _round(rows, model, heavy, at, at < ROUNDS)
        if at and loss < best - 1e-4:
            best, waited, kept = loss, 0, model
        elif at and not np.isnan(loss):
            waited += 1
        if waited >= PATIENCE:
            break
        model = after
    # Without rows that check it, the last one.
    model = kept or model
    both = all(have.get((True, c), 0) for c in (False, True))
    seen = _logits(rows.where("checks") if both else rows, model)
    _calibrate(model, seen["step"].to_numpy() / 1024, seen["toxic"].to_numpy(), seen["lang"].to_pylist(), share,
               seen["times"].to_numpy())
    return model


def score_texts(
    docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """All columns and rows, and score (0 to 1), threshold of the row's language, flagged.

    The language has no part in the score. A null or empty text has the score of a text without
    known words. A language without a threshold of its own, or none, has the common one. Columns
    that have the names of results give way to them. An empty table gives no rows.
    """
    results = {"score", "threshold", "flagged"}
    kept = [c for c in docs.columns if c.lower() not in results]
    at = kept.index(text_col) if text_col in kept else None
    lang_at = kept.index(lang_col) if lang_col in kept else None
    if at is None:
        raise ValueError(f"no column {text_col} among {kept}")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: at most `BUCKETS` words

    def scored(batches):
        model = shared.value
        for batch in batches:
            for piece in pieces(batch.rename_columns([f"c{i}" for i in range(len(kept))]), f"c{at}", PIECE):
                buckets, count = buckets_of(piece.column(at))
                score = model.score(pooled(model, model.tokens(buckets), count))
                common = model.thresholds[None]
                langs = piece.column(lang_at).to_pylist() if lang_at is not None else [None] * piece.num_rows
                limit = np.array([model.thresholds.get(x, common) for x in langs])
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(score), pa.array(limit), pa.array(score >= limit)],
                    [*kept, "score", "threshold", "flagged"],
                )

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType(list(rows.schema.fields))
    for name, kind in (("score", "double"), ("threshold", "double"), ("flagged", "boolean")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(scored, schema)
