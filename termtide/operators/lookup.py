"""Lookups: route terms to their views, read month series and top users."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import is_hashed, month_start, redact
from ..schemas import TOTALS


def one_term(spark: SparkSession, term: str) -> DataFrame:
    if not term:
        raise ValueError("a lookup needs a term")
    return spark.range(1).select(F.lit(term).alias("phrase"))


def route(terms: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Send ``#tag`` to the hashtag views, anything else to the n-gram views, lower case.
    Empty phrases are left out; equal ones are asked once."""
    text = F.col(phrase)
    tagged = text.startswith("#")
    return terms.where(text != "").select(
        text.alias("phrase"),
        F.when(tagged, "hashtag").otherwise("ngram").alias("kind"),
        F.lower(F.when(tagged, F.substring(text, 2, 2147483647)).otherwise(text)).alias("term"),
    ).distinct()


def month_series(merged: DataFrame) -> DataFrame:
    """The month counts under their display names; months without posts stay out."""
    short = {"total_like_count": "likes", "total_quote_count": "quotes",
             "total_reply_count": "replies", "total_retweet_count": "retweets"}
    return merged.select(
        "phrase", F.col("tweet_month").alias("month"), "count",
        *[F.coalesce(t, F.lit(0)).alias(short[t]) for t in TOTALS],
    )


def newest_first(series: DataFrame) -> DataFrame:
    """Rows of a phrase together, newest month first. Phrases come in no order: a global sort
    would evaluate the lookup once more to sample it. A phrase has a row per month, no more."""
    newest = F.desc(month_start(F.col("month")))
    return series.repartition("phrase").sortWithinPartitions("phrase", newest)


def user_table(users: DataFrame, extra: list[Column | str] | None = None) -> DataFrame:
    """Top users under their display names; hashed accounts are shown as redacted."""
    hashed = is_hashed(F.col("user_display_name"), F.col("user_screen_name"))
    return users.select(
        *(extra or []),
        "rank",
        redact(F.col("user_display_name"), hashed).alias("display_name"),
        redact(F.col("user_screen_name"), hashed).alias("handle"),
        F.col("user_profile_description").alias("bio"),
        F.col("user_reported_location").alias("location"),
        F.col("total_engagement_count").alias("engagement"),
        F.col("total_retweet_count").alias("retweets"),
        F.col("total_like_count").alias("likes"),
        F.col("total_quote_count").alias("quotes"),
        F.col("total_reply_count").alias("replies"),
    )
