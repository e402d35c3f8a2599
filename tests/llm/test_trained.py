"""The toxicity classifier is trained on every labelled row, whole."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termtide.llm import toxicity


def table_of(docs, labels):
    marked = labels.select(F.col("doc_id").alias("of"), (F.col("toxic") > 0).alias("toxic"))
    return toxicity._bucketed(docs, marked, 3, "doc_id", "text", "lang")


def test_all_labelled_rows_train(spark):
    """More rows of a class than were drawn once, and texts longer than were read; each comes once, in deals."""
    n = 6500
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3, F.repeat(F.lit("long text "), 5000)).otherwise("a b").alias("text"),
        F.lit("en").alias("lang"),
    )
    rows = table_of(docs.unionByName(docs.limit(5)), spark.range(n).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")))
    words = rows.select("deal", "checks", F.length("buckets").alias("bytes")).toPandas()
    assert len(words) == n and sorted(words["bytes"])[-3:] == [40_000] * 3 and sorted(words["bytes"])[-4] == 8
    assert words["deal"].nunique() == 3 and 0.15 < words["checks"].mean() < 0.25


def test_a_word_of_long_texts_is_learnt(spark):
    """Only texts of over 32 kB hold the word that tells."""
    plain = " ".join(c * 1100 for c in "abcdefghijklmnopqrstuvwxyzABCDE")
    rows = [(i, f"{plain} vile" if i % 2 else f"{plain} fair", "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(plain) > 32 << 10
    model = toxicity.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    got = {r.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    assert all((score > 0.5) == bool(i % 2) for i, score in got.items())


@pytest.mark.parametrize("stretch", [3, 7, 1 << 15])
def test_greatest_places(monkeypatch, stretch):
    """In stretches as at once; the first of equal ones."""
    pick = np.random.default_rng(3)
    model = toxicity._unfitted(np.arange(20), pick)
    count = np.array([0, 5, 1, 0, 40, 2])
    tokens = pick.integers(0, 6, count.sum())
    line, starts = toxicity.laid_out(tokens, count)
    held = toxicity.responses(model, line)
    most, place = toxicity._greatest(held, starts)
    monkeypatch.setattr(toxicity, "STRETCH", stretch)
    got, at = toxicity.greatest(model, line, starts)
    assert np.allclose(got, most, atol=1e-6)
    ends = np.append(starts[1:], len(held))
    for i, (a, b) in enumerate(zip(starts, ends)):
        assert ((at[i] >= a) & (at[i] < b)).all()
        assert np.allclose(held[at[i], np.arange(held.shape[1])], held[a:b].max(0), atol=1e-6)


def test_deals_across_batches():
    def batch(*deals):
        return pa.RecordBatch.from_pydict({"deal": pa.array(deals, pa.int32())})

    found = [(d, t.num_rows) for d, t in toxicity._deals([batch(), batch(1, 1, 2), batch(2), batch(2, 5), batch(7)])]
    assert found == [(1, 2), (2, 3), (5, 1), (7, 1)]
