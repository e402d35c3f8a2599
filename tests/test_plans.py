"""Guards on the plans, not the results."""

import pytest

from termtide.checks import adapters
from termtide.operators import leaders, terms, usage
from termtide.session import join_hint, settings, spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sizes", [[2], [5], [2, 3, 4, 5]])
def test_text_is_split_once(spark, small, sizes):
    rows = terms.ngram_rows(adapters.posts(spark, small), sizes=sizes)
    text = plan(usage.usage_by_month(rows, "ngram"))
    assert text.count("split(") == 1 and text.count("regexp_replace(") == 1
    assert "size(words" not in text.split("Generate")[0]


def test_month_view_shuffles_once_after_counting(spark, small):
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    text = plan(usage.usage_by_month(rows, "hashtag"))
    assert text.count("Exchange hashpartitioning(tweet_month") == 1
    assert "partial_count" in text.split("Exchange hashpartitioning(tweet_month")[1]


def test_ranks_are_limited_before_the_shuffle(spark, small):
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    text = plan(leaders.top_users(usage.usage_by_user(rows, "hashtag"), "hashtag"))
    after, before = text.split("Exchange hashpartitioning(hashtag#", 1)
    assert "Final" in after and "row_number(), 5, Partial" in before


def test_scan_reads_only_what_is_used(spark, small):
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    text = plan(usage.usage_by_month(rows, "hashtag"))
    assert "EqualTo(lang,en)" in text and "o_orderstatus" not in text


def test_no_python_in_any_view(spark, small):
    rows = terms.ngram_rows(adapters.posts(spark, small))
    assert "Python" not in plan(leaders.top_users(usage.usage_by_user(rows, "ngram"), "ngram"))


def test_join_by_measured_size(spark):
    table = spark.range(1000).selectExpr("cast(id as string) as a")
    assert join_hint(table) == "broadcast" and join_hint(table, limit=1000) == "merge"
    assert join_hint(table.where("a is null")) == "broadcast"


def test_leaders_are_never_the_broadcast_side(spark, small):
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    top = leaders.top_users(usage.usage_by_user(rows, "hashtag"), "hashtag")
    profiles = adapters.users(spark, small).select("user_id", *leaders.PROFILE)
    assert "SortMergeJoin [coalesce(userid" in plan(
        leaders.with_profiles(top, profiles.hint("merge"), "hashtag")
    )
    sized = plan(leaders.with_profiles(top, leaders.profiles_of(adapters.users(spark, small)), "hashtag"))
    assert "BroadcastHashJoin [coalesce(userid" in sized and "BuildRight" in sized


def test_small_scans_are_spread_and_large_ones_left(spark, small, monkeypatch):
    scan = spark.read.parquet(f"{small}/documents.parquet")
    assert "Exchange" in plan(spread(scan, "doc_id"))
    many = scan.repartition(40)
    assert spread(many, "doc_id") is many
    # A broadcast join keeps the partitions of the scan, whatever Spark's size estimate is.
    orders = spark.read.parquet(f"{small}/orders.parquet").hint("broadcast")
    joined = scan.join(orders, scan["doc_id"] == orders["o_orderkey"])
    assert "Exchange hashpartitioning(doc_id" in plan(spread(joined, "doc_id"))


def test_hashtag_lists_are_parsed_once(spark, small):
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    text = plan(usage.usage_by_month(rows, "hashtag"))
    assert text.count("split(") == 1 and text.count("regexp_replace(") == 1


def test_settings_grow_with_the_input():
    assert settings(1 << 20, 8)["spark.sql.shuffle.partitions"] == "8"
    assert int(settings(100 << 40, 4000)["spark.sql.shuffle.partitions"]) == 8_192_000
