"""Posts to term rows: one row per n-gram or hashtag use."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    SIZES,
    STOP_WORDS,
    clean_text,
    lead_of,
    longer_ngrams,
    ngrams_of_window,
    remove_stop_words,
    split_words,
    word_windows,
)
from ..functions.values import month_bucket
from ..schemas import COUNTS
from ..session import parts_for

#: The column by which rows of n-grams have been dealt out: the first two words.
LEAD = "_lead"


def posts_in_language(
    posts: DataFrame, lang: str = "en", week_year: bool = False, carried: Sequence[str] = ()
) -> DataFrame:
    """Posts of one language that have a text and a time, with their month, and the ``carried`` columns."""
    return posts.where(
        (F.col("tweet_language") == lang)
        & F.col("tweet_text").isNotNull()
        & F.col("tweet_time").isNotNull()
    ).select(
        month_bucket(F.col("tweet_time"), week_year).alias("tweet_month"),
        "tweet_text", "userid", "hashtags", *COUNTS, *carried,
    )


def with_words(
    posts: DataFrame, stop_words: Sequence[str] = STOP_WORDS, text: str = "tweet_text"
) -> DataFrame:
    """Replace the text by its words: cleaned, without empty tokens and stop words."""
    return (
        posts.withColumn("words", split_words(clean_text(F.col(text))))
        .withColumn("words", remove_stop_words("words", stop_words))
        .drop(text)
    )


def explode_ngrams(posts: DataFrame, sizes: Sequence[int] = SIZES) -> DataFrame:
    """One row per n-gram of ``words``, all sizes in one pass.

    Words hold no space, so n-grams of different sizes never fall together. Exploding
    an expression, not a column, matters: for a column Spark infers a filter on its
    size and evaluates everything the column is made of a second time for it.
    """
    grams = {1: "words"}
    rows = posts
    for n in range(2, max(sizes) + 1):
        grams[n] = f"words_{n}"
        rows = rows.withColumn(grams[n], longer_ngrams(grams[n - 1], "words", n))
    carried = [c for c in posts.columns if c != "words"]
    return rows.select(*carried, F.explode(F.concat(*[grams[n] for n in sizes])).alias("ngram"))


def dealt_ngrams(posts: DataFrame, sizes: Sequence[int] = SIZES, parts: int | None = None) -> DataFrame:
    """The rows of `explode_ngrams`, dealt out by the first two words of the n-gram, which are in the column `LEAD`,
    into as many ``parts``, or what the bytes that ``posts`` are read from ask for.

    What is shuffled is a row for each word, with the longest n-gram that begins there; its shorter ones are
    made behind the shuffle. Whatever groups by `LEAD` and the n-gram then, with or without a month or
    an account, needs no other shuffle, and nothing is gathered in memory before this one. All uses of
    two words go to one task, so how uneven tasks are follows the share of the most frequent pair of words. One-word
    n-grams have no such pair and come without the column.
    """
    least, longest = min(sizes), max(sizes)
    if least < 2:
        return explode_ngrams(posts, sizes)
    carried = [c for c in posts.columns if c != "words"]
    windows = posts.select(*carried, F.explode(word_windows("words", least, longest)).alias("window"))
    windows = windows.select(*carried, lead_of(F.col("window")).alias(LEAD), "window")
    tail = F.expr(f"substring(window, length({LEAD}) + 2)")
    windows = windows.withColumn("tail", tail).drop("window").repartition(parts or parts_for(posts), LEAD)
    return windows.select(*carried, LEAD, F.explode(ngrams_of_window(LEAD, "tail", sizes)).alias("ngram"))


def dealt(rows: DataFrame, term: str, parts: int) -> DataFrame:
    """Rows of terms of any kind, dealt out by `LEAD`."""
    return rows.withColumn(LEAD, lead_of(F.col(term))).repartition(parts, LEAD)


def keys_of(rows: DataFrame, *keys: str) -> list[str]:
    """The keys to group by: with `LEAD`, if the rows have it."""
    return [LEAD, *keys] if LEAD in rows.columns else list(keys)


def explode_hashtags(posts: DataFrame) -> DataFrame:
    """One row per hashtag in lower case; blank ones are dropped.

    The exploded thing is an expression, as in `explode_ngrams`: lists are parsed once.
    """
    carried = [c for c in posts.columns if c != "hashtags"]
    tags = posts.select(*carried, F.explode(F.transform("hashtags", F.lower)).alias("hashtag"))
    return tags.where(F.col("hashtag") != "")


def ngram_rows(
    posts, lang="en", sizes=SIZES, stop_words=STOP_WORDS, week_year=False, dealt=False,
) -> DataFrame:
    """``dealt`` rows come by `dealt_ngrams`, to be counted."""
    kept = posts_in_language(posts, lang, week_year).drop("hashtags")
    return (dealt_ngrams if dealt else explode_ngrams)(with_words(kept, stop_words), sizes)


def hashtag_rows(posts, lang="en", week_year=False) -> DataFrame:
    return explode_hashtags(posts_in_language(posts, lang, week_year).drop("tweet_text"))
