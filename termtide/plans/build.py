"""The batch build: posts and accounts to the four published views."""

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import SIZES, STOP_WORDS
from ..operators.leaders import collect_leaders, pack, profiles_of, top_users, with_profiles
from ..operators.terms import dealt_ngrams, explode_hashtags, posts_in_language, with_words
from ..operators.usage import usage_by_month, usage_by_user
from ..session import drop_folder, new_folder, spread
from ..sources.tables import View, ViewStore, keyed_by_month, write_table

# View names by kind of term.
BY_MONTH = {"ngram": "ngrams_by_month", "hashtag": "hashtags_by_month"}
TOP_USERS = {"ngram": "ngrams_top_users", "hashtag": "hashtags_top_users"}


def leaders_of(rows: DataFrame, profiles: DataFrame, term: str, k: int = 5) -> DataFrame:
    """Top users of every term, one row per (term, user), with profiles."""
    return with_profiles(top_users(usage_by_user(rows, term), term, k), profiles, term)


def packed_leaders(rows: DataFrame, profiles: DataFrame, term: str, k: int = 5) -> DataFrame:
    return pack(collect_leaders(leaders_of(rows, profiles, term, k), term), term)


def publish_month_view(store: ViewStore, rows: DataFrame, term: str) -> None:
    store.publish(usage_by_month(rows, term), BY_MONTH[term], term)


def read_month_view(spark: SparkSession, store: ViewStore, term: str) -> DataFrame:
    """The month view with its serving key. The key is made on reading: stored, it would
    hold every term a second time."""
    return keyed_by_month(store.read(spark, BY_MONTH[term]).drop("bucket"), term)


def publish_top_users(
    store: ViewStore, rows: DataFrame, profiles: DataFrame, term: str, k: int = 5
) -> None:
    store.publish(packed_leaders(rows, profiles, term, k), TOP_USERS[term], term)


def read_top_users(spark: SparkSession, store: ViewStore, term: str) -> DataFrame:
    return store.read(spark, TOP_USERS[term]).drop("bucket")


def build_views(
    spark: SparkSession, posts: DataFrame, users: DataFrame | None, store: ViewStore,
    lang: str = "en", sizes: Sequence[int] = SIZES, k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS, week_year: bool = False, counted: int | None = None,
) -> None:
    """Replace all four views, or without ``users`` the two month views, at once: readers see
    the old ones until the last is written, and go on seeing them if the build fails.

    ``counted`` is the last counter batch whose posts are among ``posts``; it is stored with
    the views, and lookups add later batches only. Without ``users``, top users published
    before stay as they are.

    The cleaned words are written once, in the shared folder, and read by both n-gram
    jobs: cleaning costs more than reading the words back, and a lost executor then
    repeats only its own files.
    """
    folder, views = new_folder(spark, "words"), []
    try:
        for view in _written(posts, users, store, folder, lang, sizes, k, stop_words, week_year):
            views.append(view)
    except BaseException:
        for view in views:
            drop_folder(spark, view.path)
        raise
    finally:
        drop_folder(spark, folder)
    store.release(spark, views, counted)


def _written(posts, users, store, folder, lang, sizes, k, stop_words, week_year) -> Iterator[View]:
    kept = posts_in_language(spread(posts, "tweetid"), lang, week_year)
    words = write_table(with_words(kept, stop_words), folder)
    rows = {
        "ngram": dealt_ngrams(words.drop("hashtags"), sizes),
        "hashtag": explode_hashtags(words.drop("words")),
    }
    for term in rows:
        yield store.write(usage_by_month(rows[term], term), BY_MONTH[term], term)
    if users is not None:
        profiles = profiles_of(users, words)
        for term in rows:
            yield store.write(packed_leaders(rows[term], profiles, term, k), TOP_USERS[term], term)
