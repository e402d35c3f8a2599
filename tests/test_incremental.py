"""Totals kept up by changes, against totals built anew."""

import random

import pytest
from pyspark.sql import functions as F

from termtide.checks import adapters
from termtide.operators import leaders, signed, terms, usage
from termtide.plans.incremental import KEYS, Totals, bucket_count, follow
from termtide.session import joined_as_laid_out, names_in, new_folder


@pytest.fixture
def totals(spark):
    return Totals(new_folder(spark, "totals"), buckets=4)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def same(totals, spark, posts):
    """All views equal those of the posts."""
    for kind, rows in (("ngram", terms.ngram_rows(posts)), ("hashtag", terms.hashtag_rows(posts))):
        accounts = usage.usage_by_user(rows, kind)
        assert rows_of(totals.months(spark, kind)) == rows_of(usage.usage_by_month(rows, kind))
        assert rows_of(totals.accounts(spark, kind)) == rows_of(accounts)
        assert rows_of(totals.leaders(spark, kind)) == rows_of(leaders.top_users(accounts, kind))


def snapshot(post, pick, n):
    words = ["red", "fox", "runs", "far", "snow"]
    return post(*[
        {
            "tweetid": str(i), "userid": pick.choice(["u1", "u2", "u3", None]),
            "tweet_text": pick.choice([None, " ".join(pick.choice(words) for _ in range(pick.randrange(6)))]),
            "quote_count": pick.choice([None, 1, 5]), "hashtags": pick.choice([None, ["Fox"], ["fox", "snow", ""]]),
            "tweet_language": pick.choice(["en", "en", "de"]),
        }
        for i in range(n)
    ])


def test_changes_follow_snapshots(spark, post, totals):
    pick = random.Random(2)
    first = snapshot(post, pick, 30)
    totals.build(first)
    for n in (34, 0):
        second = snapshot(post, pick, n)
        follow(totals, first, second)
        same(totals, spark, second)
        first = second
    # Two versions, of six tables each.
    assert len(names_in(spark, f"{totals.root}/versions")) == 2 and len(names_in(spark, f"{totals.root}/tables")) == 12


def test_changes_of_posts(spark, post):
    def rows(*ids):
        return post(*[{"tweetid": i, "tweet_text": t, "userid": u, "hashtags": h} for i, t, u, h in ids])

    before = rows(("1", "a", None, None), ("2", "b", "u", ["x"]), ("2", "b", "u", ["x"]), (None, "c", "u", []), ("5", None, "t", None))
    after = rows(("1", None, "a", None), ("2", "b", "u", ["x"]), ("3", "d", "u", ["x", None]), (None, "c", "u", []), ("5", None, "t", None), ("4", "e", "u", None), ("4", "e", "u", None))
    changed = signed.post_changes(before, after)
    got = sorted((r.tweetid, r.tweet_text or "", r.sign) for r in changed.collect())
    assert got == [("1", "", 1), ("1", "a", -1), ("2", "b", -1), ("3", "d", 1), ("4", "e", 2)]
    assert signed.post_changes(after, after).isEmpty()
    # Nulls are told apart by where they are.
    assert signed.post_changes(rows(("1", "x", None, None)), rows(("1", None, "x", None))).count() == 2


def test_taking_away_the_last_value_leaves_null(spark, post, totals):
    both = post({"tweetid": "1"}, {"tweetid": "2", "quote_count": None})
    totals.build(both)
    month = lambda: totals.months(spark, "ngram").where("ngram = 'red fox'").first()
    assert (month()["count"], month().total_quote_count) == (2, 1)
    totals.apply(both.where("tweetid = '1'").withColumn("sign", F.lit(-1)))
    assert (month()["count"], month().total_quote_count) == (1, None)
    totals.apply(both.where("tweetid = '2'").withColumn("sign", F.lit(-1)))
    assert month() is None and totals.leaders(spark, "ngram").isEmpty()


def test_a_failed_change_leaves_the_version(spark, post, totals, monkeypatch):
    posts = post({"hashtags": ["fox"]})
    totals.build(posts)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(Totals, "_reranked", broken)
    with pytest.raises(RuntimeError, match="lost"):
        totals.apply(signed.added(posts))
    same(totals, spark, posts)
    assert len(names_in(spark, f"{totals.root}/tables")) == 6
    with pytest.raises(LookupError):
        Totals(new_folder(spark, "none")).months(spark, "ngram")


def test_tables_are_found_by_a_later_session(spark, post, totals):
    posts = post({"hashtags": ["fox"]}, {"userid": "u2", "hashtags": ["fox"]})
    totals.build(posts)
    for table in totals.tables(spark).values():
        spark.sql(f"drop table {table.name}")
    same(totals, spark, posts)
    totals.apply(signed.added(posts))
    same(totals, spark, posts.unionByName(posts))


def test_many_touched_terms_are_ranked_before_they_are_picked(spark, small, totals, monkeypatch):
    posts = adapters.posts(spark, small)
    totals.build(posts.where("tweet_client_name < 'src5'"))
    from termtide.plans import incremental

    monkeypatch.setattr(incremental, "join_hint", lambda rows, limit=0: "merge")
    totals.apply(signed.added(posts.where("tweet_client_name >= 'src5'")))
    accounts = usage.usage_by_user(terms.ngram_rows(posts), "ngram")
    assert rows_of(totals.leaders(spark, "ngram")) == rows_of(leaders.top_users(accounts, "ngram"))


def exchanges_above_scan(df, table):
    """Exchanges between the scan of a table and the join that takes it."""
    def walk(node):
        """None: not below; else what is above the scan, up to the first join."""
        name = node.nodeName()
        if name.startswith("Scan parquet") and table in node.toString():
            return []
        children = node.children()
        for i in range(children.size()):
            found = walk(children.apply(i))
            if found is not None:
                return found if "Join" in " ".join(found) else [*found, name]
        return None

    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.inputPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    return walk(plan)


@pytest.mark.parametrize("kind", ["ngram", "hashtag"])
def test_the_base_is_not_shuffled(spark, small, totals, kind):
    posts = adapters.posts(spark, small)
    totals.build(posts.where("tweet_client_name < 'src5'"))
    delta = signed.added(posts.where("tweet_client_name >= 'src5'"))
    rows = totals._uses(delta, new_folder(spark, "words"))[kind]
    for state, of in (("months", signed.by_month), ("accounts", signed.by_account)):
        table = totals.tables(spark)[f"{kind}_{state}"]
        merged = signed.merged(table.scan(spark), of(rows, kind), KEYS[state])
        above = exchanges_above_scan(merged, table.name)
        assert any("SortMergeJoin" in n for n in above) and not any("Exchange" in n for n in above)
    # The scan of all accounts is ranked by partition before anything is shuffled.
    table = totals.tables(spark)[f"{kind}_accounts"]
    text = totals._ranked(table.scan(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text.split("Exchange")[-1]


def shuffled(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_ngram_totals_are_shuffled_as_windows_only(spark, small, totals):
    """Each state has one shuffle, of windows; ranks, and what is written, have none."""
    posts = adapters.posts(spark, small)
    totals.build(posts.where("tweet_client_name < 'src5'"))
    rows = totals._uses(signed.added(posts.where("tweet_client_name >= 'src5'")), new_folder(spark, "words"))["ngram"]
    tables = totals.tables(spark)
    for state, of in (("months", signed.by_month), ("accounts", signed.by_account)):
        with joined_as_laid_out(spark):
            found = shuffled(signed.merged(tables[f"ngram_{state}"].scan(spark), of(rows, "ngram"), KEYS[state]))
        assert len(found) == 1 and terms.LEAD in found[0] and "term" not in found[0]
    accounts, leading = tables["ngram_accounts"].scan(spark), tables["ngram_leaders"].scan(spark)
    few = spark.createDataFrame([("a b",)], "term string")
    for touched in (None, few):
        assert not shuffled(totals._reranked(leading, accounts, touched))


def test_totals_written_by_their_keys_are_kept_up(spark, post, totals):
    """As n-gram totals of before were: without the first words, bucketed by term and month or account."""
    posts = post({"hashtags": ["fox"]}, {"userid": "u2", "tweet_text": "red fox runs far"})
    totals.build(posts)
    old = {}
    for name, table in totals.tables(spark).items():
        kind, state = name.split("_")
        old[name] = totals._write(table.scan(spark).drop(terms.LEAD), kind, state, table.buckets, False)
    totals._show(spark, old)
    same(totals, spark, posts)
    more = post({"tweet_text": "red fox runs"}, {"userid": "u3"})
    totals.apply(signed.added(more))
    same(totals, spark, posts.unionByName(more))


def test_many_changed_words_are_not_gathered(spark, post, totals, monkeypatch):
    from termtide.plans import incremental

    posts = post({"tweetid": "1"}, {"tweetid": "2", "userid": "u2"})
    totals.build(posts)
    monkeypatch.setattr(incremental, "FEW_BYTES", 0)
    totals.apply(posts.where("tweetid = '1'").withColumn("sign", F.lit(-1)))
    same(totals, spark, posts.where("tweetid = '2'"))


def test_buckets_follow_the_size():
    assert [bucket_count(s, 8) for s in (0, 1 << 20, 64 << 20, 100 << 30)] == [1, 1, 8, 800]
