"""Usage of a term by month and by account.

Both are plain hash aggregations: every map task first counts its own rows per key, so a
term that makes up a third of all rows reaches the shuffle as one row per task and key. Rows that
have been dealt out by `terms.LEAD` are counted where they are, and keep that column.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COUNTS
from .terms import keys_of


def _totals() -> list[Column]:
    return [F.sum(c).alias(f"total_{c}") for c in COUNTS]


def usage_by_month(rows: DataFrame, term: str) -> DataFrame:
    return rows.groupBy(*keys_of(rows, "tweet_month", term)).agg(F.count("*").alias("count"), *_totals())


def engagement(null_as_zero: bool = False) -> Column:
    """Sum of the four counts of a post. A post that lacks one of them adds nothing,
    unless a missing count is to be taken as 0."""
    parts = [F.coalesce(c, F.lit(0)) if null_as_zero else F.col(c) for c in COUNTS]
    whole = parts[0].cast("long")
    for part in parts[1:]:
        whole = whole + part
    return F.sum(whole)


def usage_by_user(rows: DataFrame, term: str, null_as_zero: bool = False) -> DataFrame:
    return rows.groupBy(*keys_of(rows, term, "userid")).agg(
        F.count("*").alias("count"),
        engagement(null_as_zero).alias("total_engagement_count"),
        *_totals(),
    )
