"""N-grams dealt out by their first words: the same rows, and one shuffle whatever is counted."""

import pytest
from pyspark.sql import functions as F

from termtide.checks import adapters, queries
from termtide.operators import merge, terms
from termtide.operators.usage import usage_by_month
from termtide.session import new_folder, parts_for
from termtide.sources.runs import LOOSE_BUCKETS
from termtide.sources.tables import ViewStore
from termtide.streaming.counters import CounterLog, batch_parts, count_terms


@pytest.mark.parametrize("sizes", [[2], [5], [2, 5], [3, 4], [2, 3, 4, 5], [1, 2]])
def test_same_rows(spark, sizes):
    texts = [None, [], ["a"], ["a", "b"], ["a", "b", "a"], ["a", "a", "a", "a"], list("abcdefgh"), ["a_b"] * 6]
    posts = spark.createDataFrame(list(enumerate(texts)), "id int, words array<string>")
    whole, dealt = terms.explode_ngrams(posts, sizes), terms.dealt_ngrams(posts, sizes)
    assert sorted(whole.collect()) == sorted(dealt.drop(terms.LEAD).select(whole.columns).collect())
    if min(sizes) > 1:
        wrong = dealt.where(F.substring_index("ngram", " ", 2) != F.col(terms.LEAD))
        assert wrong.isEmpty()


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("name", [
    "ngrams_by_month", "ngrams_by_user", "top_users_by_ngram", "ngram_top_users_info", "ngram_top_users_packed",
])
def test_ngrams_are_shuffled_once(spark, small, name):
    """Beside what joins posts and picks profiles there is one shuffle, of windows."""
    found = [e for e in exchanges(queries.QUERIES[name](spark, small)) if "ngram#" in e or terms.LEAD in e]
    assert len(found) == 1 and f"hashpartitioning({terms.LEAD}#" in found[0]


def test_a_dealt_view_is_not_shuffled_again(spark, small, monkeypatch):
    """It is written as it lies, not staged; a term is found in its bucket."""
    rows = queries.rows_of(spark, small, "ngram").groupBy(terms.LEAD, "ngram").agg(F.count("*").alias("count"))
    store = ViewStore(new_folder(spark, "views"))
    monkeypatch.setattr("termtide.sources.tables.write_table", None)
    view = store.write(rows, "counts", "ngram")
    found = view.scan(spark)
    assert found.where(F.col("bucket") != view.bucket(F.col("ngram"))).isEmpty() and terms.LEAD not in found.columns
    assert found.count() == rows.count()
    files = [f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()]
    assert len(files) == len(set(files))


def test_parts_follow_the_files(spark, small):
    documents = adapters.listed_posts(spark, small)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts_for(documents) == least and parts_for(spark.range(10)) == least
    assert parts_for(documents, 4096) >= 64 and parts_for(documents, 4096).bit_count() == 1


def test_counters_are_shuffled_once(spark, small):
    """N-grams by their first words, not as counts again; a full merge of two that are dealt out alike has no shuffle."""
    posts = adapters.posts(spark, small)
    counted = count_terms(posts)
    assert not [e for e in exchanges(counted) if "ngram#" in e or "term#" in e]
    log = CounterLog(new_folder(spark, "counters"))
    log.add(posts, 0)
    batch = usage_by_month(terms.ngram_rows(posts, dealt=True), "ngram")
    speed = log.read(spark, "ngram", parts=parts_for(posts))
    assert terms.LEAD not in log.read(spark, "ngram").columns
    merged = merge.merge_views(batch, speed, "ngram", "full")
    assert len([e for e in exchanges(merged) if terms.LEAD in e or "ngram#" in e]) == 2  # one a side
    assert merged.agg(F.sum("count")).first()[0] == 2 * terms.ngram_rows(posts).count()


def test_batches_are_dealt_by_their_bytes(spark):
    """A large batch isn't left to as many tasks as there are buckets."""
    value = F.repeat(F.lit("x"), 1 << 20).alias("value")
    assert batch_parts(spark.range(3).select(value)) == LOOSE_BUCKETS
    assert batch_parts(spark.range(100).select(value)) == 32 and batch_parts(spark.range(0).select(value)) == LOOSE_BUCKETS
