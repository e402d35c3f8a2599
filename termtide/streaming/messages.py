"""Message bodies to posts, with the unusable ones set apart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import blank_to_null
from ..schemas import MESSAGE_FIELDS, NEEDED_FIELDS, all_strings
from ..sources.posts import normalize_posts

_BAD = "_corrupt_record"
_BODY = all_strings([*MESSAGE_FIELDS, _BAD])


def parse_messages(messages: DataFrame) -> DataFrame:
    """The message fields as text, and ``reason``: why a message cannot be counted, or
    NULL. Time, text and language may be null or blank but must be there; any other field
    that is absent is NULL."""
    body = F.from_json(
        "value", _BODY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    )
    absent = F.array_except(
        F.array(*[F.lit(c) for c in NEEDED_FIELDS]), F.json_object_keys("value")
    )
    parsed = messages.select("value", body.alias("body"), absent.alias("absent"))
    time = blank_to_null(F.col("body.tweet_time"))
    # A body that is no JSON object has no keys to list, so `absent` is NULL for it.
    reason = (
        F.when(F.col(f"body.{_BAD}").isNotNull() | F.col("absent").isNull(), "malformed")
        .when(F.size("absent") > 0, F.concat(F.lit("missing: "), F.array_join("absent", ", ")))
        .when(time.isNotNull() & time.try_cast("timestamp").isNull(), "malformed: tweet_time")
    )
    return parsed.select("value", reason.alias("reason"), *[f"body.{c}" for c in MESSAGE_FIELDS])


def usable_posts(parsed: DataFrame) -> DataFrame:
    return normalize_posts(parsed.where(F.col("reason").isNull()))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("reason", "value")
