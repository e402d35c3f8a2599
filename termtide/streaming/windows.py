"""Windows over the time of posts: sliding windows of a term's use, sessions of an account.

Both are append streams: a window is written once, when the watermark has passed its end, with all posts
in it, in whatever order they came; posts that come later than ``delay`` behind the newest are left out.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.terms import explode_hashtags, explode_ngrams, posts_in_language, with_words
from ..operators.usage import engagement
from ..schemas import COUNTS, TOTALS
from .messages import parse_messages, usable_posts


def timed_posts(messages: DataFrame, delay: str, lang: str = "en", week_year: bool = False) -> DataFrame:
    """Usable posts of one language from a stream of messages, with a watermark on their time."""
    posts = usable_posts(parse_messages(messages))
    kept = posts_in_language(posts, lang, week_year, ["tweet_time"]).drop("tweet_month")
    return kept.withWatermark("tweet_time", delay)


def term_windows(posts: DataFrame, kind: str, length: str, slide: str, sizes=(2,)) -> DataFrame:
    """Uses and reactions of each term in windows of ``length`` that begin every ``slide``."""
    if kind == "hashtag":
        rows = explode_hashtags(posts.drop("tweet_text", "userid"))
    else:
        rows = explode_ngrams(with_words(posts.drop("hashtags", "userid")), list(sizes))
    counted = rows.groupBy(F.window("tweet_time", length, slide), kind).agg(
        F.count("*").alias("count"), *[F.coalesce(F.sum(c), F.lit(0)).alias(t) for c, t in zip(COUNTS, TOTALS)]
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), kind, "count", *TOTALS
    )


def account_sessions(posts: DataFrame, gap: str) -> DataFrame:
    """Sessions of each account: posts that follow one another in less than ``gap``. Posts without
    an account are in none."""
    rows = posts.where(F.col("userid").isNotNull()).groupBy(F.session_window("tweet_time", gap), "userid")
    return rows.agg(F.count("*").alias("posts"), engagement(null_as_zero=True).alias("total_engagement_count")).select(
        "userid", F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"), "posts", "total_engagement_count",
    )


def start_writing(windows: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append closed windows to a table."""
    return (
        windows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start(table)
    )
