import json
import os

import pytest
from pyspark.sql import functions as F

from termtide.checks import adapters
from termtide.checks.queries import _text_posts
from termtide.operators import terms, usage
from termtide.schemas import MESSAGE_FIELDS
from termtide.session import names_in, new_folder, write_text
from termtide.sources import messages as msg
from termtide.sources.runs import layout, level
from termtide.streaming.counters import _COUNTERS, CounterLog, start_counting
from termtide.streaming.messages import parse_messages

BODY = {
    "tweet_time": "2017-03-05 12:00", "tweet_text": "red fox", "tweet_language": "en", "userid": "u",
    "hashtags": "[a]", "quote_count": "1", "reply_count": "", "like_count": "2", "retweet_count": "x",
}


def as_messages(spark, *bodies):
    texts = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return spark.createDataFrame(texts, "value string")


@pytest.fixture
def log(spark):
    return CounterLog(new_folder(spark, "counters"))


def counted(spark, log, kind="ngram", **k):
    return sorted(map(tuple, log.read(spark, kind, **k).select(kind, "tweet_month", "count").collect()))


def test_reasons(spark):
    lacking = {k: v for k, v in BODY.items() if k not in ("hashtags", "userid")}
    messages = as_messages(
        spark, BODY, json.dumps(BODY)[:-3], "", "[1]", lacking, {**BODY, "tweet_time": "soon"},
        {**BODY, "tweet_time": ""}, {**BODY, "tweet_text": None}, {"tweet_text": "a", "userid": "u"},
    )
    assert [r["reason"] for r in parse_messages(messages).collect()] == [
        None, "malformed", "malformed", "malformed", None,
        "malformed: tweet_time", None, None, "missing: tweet_time, tweet_language",
    ]


def test_counts_and_nulls(spark, log):
    log.apply(as_messages(spark, BODY, {**BODY, "tweet_text": ""}, "oops"), 0)
    row = log.read(spark, "ngram").first()
    assert tuple(row) == ("03-2017", "red fox", 1, 1, 0, 2, 0)
    assert counted(spark, log, "hashtag") == [("a", "03-2017", 1)]
    assert [tuple(r) for r in log.read_dead_letters(spark).collect()] == [("malformed", "oops")]


def test_replay_changes_nothing(spark, log):
    log.apply(as_messages(spark, BODY), 0)
    log.apply(as_messages(spark, BODY, BODY), 1)
    before = counted(spark, log)
    log.apply(as_messages(spark, BODY, BODY), 1)
    assert counted(spark, log) == before == [("red fox", "03-2017", 3)]


def test_half_written_batch_is_not_read(spark, log):
    log.apply(as_messages(spark, BODY), 0)
    log.apply(as_messages(spark, BODY), 1)
    os.rename(f"{log.root}/counts/batch_id=1/_SUCCESS", f"{log.root}/counts/batch_id=1/_other")
    assert counted(spark, log) == [("red fox", "03-2017", 1)]


def test_compaction_keeps_sums_and_later_batches_add(spark, log):
    assert log.compact(spark) is None and counted(spark, log) == []
    for n in range(3):
        log.apply(as_messages(spark, BODY), n)
    assert log.compact(spark) == 2
    assert counted(spark, log) == [("red fox", "03-2017", 3)]
    log.apply(as_messages(spark, BODY), 3)
    assert counted(spark, log) == [("red fox", "03-2017", 4)]
    assert log.compact(spark) == 3 and counted(spark, log) == [("red fox", "03-2017", 4)]
    assert counted(spark, log, after=1) == [("red fox", "03-2017", 2)]


def test_empty_batch_is_known_and_a_lost_one_is_missed(spark, log):
    log.apply(as_messages(spark), 0)
    log.apply(as_messages(spark, BODY), 1)
    assert log.batches(spark) == [0, 1] and counted(spark, log) == [("red fox", "03-2017", 1)]
    log.apply(as_messages(spark, BODY), 3)
    with pytest.raises(RuntimeError, match="batch 2"):
        log.read(spark, "ngram")
    assert counted(spark, log, after=2) == [("red fox", "03-2017", 1)]


def test_folds_are_cleared_and_read_after_a_mark(spark, log):
    for n in range(4):
        log.apply(as_messages(spark, BODY), n)
    assert log.compact(spark, after=1, clear=True) == 3
    assert log.batches(spark) == [] and log.folds(spark) == [(2, 3)]
    assert counted(spark, log, after=1) == [("red fox", "03-2017", 2)]
    log.apply(as_messages(spark, BODY), 4)
    assert counted(spark, log, after=1) == [("red fox", "03-2017", 3)]
    assert log.compact(spark, after=1, clear=True) == 4 and log.folds(spark) == [(2, 4)]
    assert counted(spark, log, after=1) == [("red fox", "03-2017", 3)]
    for mark in (None, 2):
        with pytest.raises(RuntimeError):
            log.read(spark, "ngram", after=mark)


def put(spark, log, n, *counts):
    """A batch of counters as they are: (n-gram, count)."""
    rows = [(kind, term, "03-2017", c, 1, 0, 2, 0) for term, c in counts for kind in ("ngram", "hashtag")]
    log.store.write_batch(spark.createDataFrame(rows, _COUNTERS).coalesce(1), n)


def test_runs_by_level(spark, log):
    """One run of each level at most, however many batches, and the same sums as without folds."""
    for n in range(13):
        put(spark, log, n, *[("red fox", n)] * (n % 3))
        log.fold(spark, fanout=3)
        sizes = [last - first + 1 for first, last in log.folds(spark)]
        levels = [level(s, 3) for s in sizes]
        assert levels == sorted(set(levels), reverse=True) and sum(sizes) == 3 * ((n + 1) // 3)
        if n in (2, 5, 12):
            assert counted(spark, log) == [("red fox", "03-2017", sum(i * (i % 3) for i in range(n + 1)))]
    # A batch that is tried again after its fold changes nothing.
    before = counted(spark, log)
    put(spark, log, 4, ("red fox", 100))
    assert counted(spark, log) == before
    # Batches stay, so readers of a later mark find what lies in a run with others.
    assert counted(spark, log, after=9) == [("red fox", "03-2017", sum(i * (i % 3) for i in range(10, 13)))]


def test_one_term_opens_one_bucket_of_each_piece(spark, log):
    for n in range(11):
        put(spark, log, n, *[(f"red fox{i}", 1) for i in range(60)])
        log.fold(spark, fanout=3)
    pieces = log.store.pieces(spark)
    assert [len(p) for p in pieces] == [6, 3, 1, 1]
    one = spark.range(1).select(F.lit("red fox7").alias("term"))
    opened = log.store.rows(spark, pieces, "ngram", one).inputFiles()
    assert len(opened) == len(pieces) and len({f.split("/kind=")[0] for f in opened}) == len(pieces)
    found = log.read(spark, "ngram", one)
    assert [tuple(r)[:3] for r in found.collect()] == [("03-2017", "red fox7", 11)]
    assert "EqualTo(term,red fox7)" in found._jdf.queryExecution().executedPlan().toString()
    assert len(log.store.rows(spark, pieces, "ngram").inputFiles()) > 2 * len(pieces)
    none = log.read(spark, "ngram", spark.range(0).select(F.lit("x").alias("term")))
    assert none.isEmpty() and none.columns == found.columns


def test_an_unfinished_fold_is_not_read(spark, log):
    for n in range(4):
        put(spark, log, n, ("red fox", 1))
    log.store._fold(spark, log.store.pieces(spark))
    assert log.folds(spark) == [] and counted(spark, log) == [("red fox", "03-2017", 4)]
    assert log.fold(spark, fanout=3) == (0, 3) and counted(spark, log) == [("red fox", "03-2017", 4)]


def test_old_runs_go_one_fold_later(spark, log):
    for n in range(7):
        put(spark, log, n, ("red fox", 1))
        log.fold(spark, fanout=2)
    runs = names_in(spark, f"{log.root}/runs")
    kept = {(r.first, r.last) for v in log.store._versions(spark) for r in log.store._named(spark, v)}
    there = {
        (int(a.split("=")[1]), int(b.split("=")[1]))
        for a in runs for b in names_in(spark, f"{log.root}/runs/{a}") if b.startswith("batch_id=")
    }
    assert there == kept and len(log.store._versions(spark)) == 2
    with pytest.raises(FileExistsError):
        write_text(spark, f"{log.root}/manifest/{log.store._versions(spark)[-1]:08d}", "[]")


def test_run_layout():
    assert layout(0) == (8, 1) and layout(10 << 30) == (128, 1) and layout(10 << 40) == (1024, 80)
    assert [level(n, 3) for n in (1, 2, 3, 4, 9, 10)] == [0, 1, 1, 2, 2, 3]


def test_absent_counts_are_null_and_counted(spark, log):
    log.apply(as_messages(spark, {k: BODY[k] for k in ("tweet_time", "tweet_text", "tweet_language")}), 0)
    assert tuple(log.read(spark, "ngram").first()) == ("03-2017", "red fox", 1, 0, 0, 0, 0)


def test_messages_of_rows(spark):
    rows = spark.createDataFrame([("1", "", None, 'a "b"\nc')], "tweetid string, a string, b string, t string")
    assert json.loads(msg.to_messages(rows).first()[0]) == {"tweetid": "1", "a": "", "b": None, "t": 'a "b"\nc'}


def test_chunks_equal_batch(spark, small):
    """The stream in several micro-batches counts what one batch run counts."""
    path = new_folder(spark, "messages")
    messages = msg.to_messages(_text_posts(spark, small).select(*MESSAGE_FIELDS))
    msg.write_message_files(messages.repartition(4), path)
    log = CounterLog(new_folder(spark, "counters"))
    source = msg.file_messages(spark, path, 1)
    start_counting(source, log, {"availableNow": True}).awaitTermination()
    assert len(log.batches(spark)) == 4
    start_counting(source, log, {"availableNow": True}).awaitTermination()
    rows = terms.hashtag_rows(adapters.posts(spark, small))
    whole = usage.usage_by_month(rows, "hashtag").na.fill(0)
    got = log.read(spark, "hashtag").select(*whole.columns)
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        msg.kafka_messages(spark, "localhost:9092", "posts", 10, 4)
