import os
import re

import pytest

from termtide.operators.lookup import one_term, route
from termtide.plans import build, serve
from termtide.session import new_folder
from termtide.sources.tables import ViewStore
from termtide.streaming.counters import CounterLog

from test_views import users_of


@pytest.fixture
def store(spark, post):
    from datetime import datetime

    posts = post(
        {"hashtags": ["Fox"]}, {"tweet_time": datetime(2016, 11, 2), "userid": "u2", "hashtags": ["fox"]},
        {"tweet_time": datetime(2017, 1, 2), "tweet_text": "snake_case fox"},
    )
    users = users_of(spark, ("u1", None), ("u2", ("f" * 64, "e" * 64, None, "bio")))
    store = ViewStore(new_folder(spark, "views"), buckets=4)
    build.build_views(spark, posts, users, store)
    return store


def test_route(spark):
    terms = spark.createDataFrame([("#Fox",), ("Red Fox",), ("",), (None,), ("#Fox",)], "phrase string")
    got = sorted((r["phrase"], r["kind"], r["term"]) for r in route(terms).collect())
    assert got == [("#Fox", "hashtag", "fox"), ("Red Fox", "ngram", "red fox")]


def test_empty_term(spark):
    with pytest.raises(ValueError):
        one_term(spark, "")


def test_newest_month_first_without_zero_months(spark, store):
    series, _ = serve.lookup(spark, store, "Red Fox")
    assert [(r["month"], r["count"]) for r in series.collect()] == [("03-2017", 1), ("11-2016", 1)]


def test_users_in_rank_order_and_redacted(spark, store):
    _, users = serve.lookup(spark, store, "#fox")
    got = [(r["rank"], r["display_name"], r["handle"], r["location"]) for r in users.collect()]
    assert got == [(1, "name", "handle", "place"), (2, "<Redacted>", "<Redacted>", "")]


def test_prefix_of_a_term_with_underscore_does_not_match(spark, store):
    assert serve.lookup(spark, store, "snake")[0].count() == 0
    assert serve.lookup(spark, store, "snake_case fox")[0].count() == 1


def test_counters_are_added(spark, store, post):
    from datetime import datetime

    log = CounterLog(new_folder(spark, "counters"))
    log.add(post({"hashtags": ["fox"]}, {"hashtags": ["fox"], "tweet_time": datetime(2018, 1, 1)}), 0)
    terms = one_term(spark, "#fox")
    left = serve.lookup_series(spark, store, terms, log).collect()
    assert [(r["month"], r["count"], r["likes"]) for r in left] == [("03-2017", 2, 6), ("11-2016", 1, 3)]
    full = serve.lookup_series(spark, store, terms, log, "full").collect()
    assert [(r["month"], r["count"]) for r in full] == [("01-2018", 1), ("03-2017", 2), ("11-2016", 1)]


def test_batches_that_the_views_hold_are_not_added_again(spark, store, post):
    log = CounterLog(new_folder(spark, "counters"))
    posts = post({"hashtags": ["fox"]})
    log.add(posts, 0)
    build.build_views(spark, posts, None, store, counted=0)
    count = lambda: [r["count"] for r in serve.lookup(spark, store, "#fox", log)[0].collect()]
    assert count() == [1]
    log.add(post({"hashtags": ["fox"]}), 1)
    assert count() == [2]
    log.compact(spark, store.mark(spark), clear=True)
    assert count() == [2]


def test_one_term_reads_one_bucket(spark, store):
    series, _ = serve.lookup(spark, store, "#fox")
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(\d+ = bucket", plan)
    assert "EqualTo(hashtag,fox)" in plan


def test_terms_are_evaluated_once(spark, store):
    """Terms from a table, through both kinds, the measured size and the buckets of the counters."""
    asked = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            asked.add(len(batch))
            yield batch

    terms = spark.createDataFrame([("#fox",), ("red fox",), ("nothing",)], "phrase string").coalesce(1)
    terms = terms.mapInPandas(seen, "phrase string")
    log = CounterLog(new_folder(spark, "counters"))
    found = serve.lookup_series(spark, store, terms, log)
    assert {r["phrase"] for r in found.collect()} == {"#fox", "red fox"} and asked.value == 3


def test_layout_for_a_size():
    assert ViewStore.for_size("x", 1 << 20).buckets == 32
    big = ViewStore.for_size("x", 10 << 40)
    assert big.buckets == 1024 and big.files_per_bucket == 40


def test_files_per_bucket(spark, store, post):
    wide = ViewStore(store.root, buckets=2, files_per_bucket=3)
    view = store.read(spark, "ngrams_by_month").drop("bucket")
    wide.publish(view, "ngrams_by_month", "ngram")
    assert sorted(wide.read(spark, "ngrams_by_month").drop("bucket").collect()) == sorted(view.collect())


def test_layout_follows_the_measured_size():
    store = ViewStore("x")
    assert store.layout(1000, 8) == (1, 1)
    assert store.layout(100 << 20, 8) == (8, 1)
    assert store.layout(10 << 30, 8) == (40, 1)
    assert store.layout(10 << 40, 8) == (1024, 40)


def test_a_failed_build_leaves_the_views(spark, store, post, monkeypatch):
    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(build, "packed_leaders", broken)
    with pytest.raises(RuntimeError, match="lost"):
        build.build_views(spark, post({"hashtags": ["fox"]}), users_of(spark, ("u1", None)), store, counted=3)
    series, users = serve.lookup(spark, store, "#fox")
    assert [r["count"] for r in series.collect()] == [1, 1] and users.count() == 2
    assert store.mark(spark) is None
    assert len(os.listdir(f"{store.root}/views")) == 4


def test_old_views_go_after_the_next_release(spark, store, post):
    began, _ = serve.lookup(spark, store, "#fox")
    measured = ViewStore(store.root)
    for counted in (0, 1):
        build.build_views(spark, post({"hashtags": ["fox"]}), None, measured, counted=counted)
        if counted == 0:
            assert [r["count"] for r in began.collect()] == [1, 1]
    assert store.mark(spark) == 1
    assert [r["count"] for r in serve.lookup(spark, store, "#fox")[0].collect()] == [1]
    # Two versions of both month views, one of the top users.
    assert len(os.listdir(f"{store.root}/views")) == 6
    with pytest.raises(LookupError):
        store.open(spark, "nothing")
