"""The accounts with most engagement per term, their profiles, and list forms of them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import SEPARATOR
from ..schemas import TOTALS
from ..session import join_hint
from .terms import keys_of

NUMBERS = ["total_engagement_count", *TOTALS]
PROFILE = [
    "user_display_name", "user_screen_name", "user_reported_location",
    "user_profile_description",
]
# Packed column of each field of a top user.
PACKED = {c: f"{c}s" for c in [*PROFILE, *NUMBERS]}


def top_users(usage: DataFrame, term: str, k: int = 5) -> DataFrame:
    """The ``k`` accounts with most engagement per term, ties by account id.

    The rank filter is applied to each partition of the (term, account) counts before
    the shuffle by term, so a term used by a third of all accounts sends on ``k`` rows
    a partition. Rows dealt out by `terms.LEAD` have all accounts of a term in one partition already.
    """
    order = Window.partitionBy(*keys_of(usage, term)).orderBy(F.desc("total_engagement_count"), F.asc("userid"))
    return usage.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def profiles_of(users: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """The profile columns, with the join strategy their measured size calls for; with ``posts`` those of
    their accounts only.

    An account that comes in several rows has the profile that is least, compared column by
    column, so no list of top users holds it twice.
    """
    if posts is not None:
        accounts = posts.select(F.col("userid").alias("account")).distinct()
        users = users.join(accounts, users["user_id"].eqNullSafe(accounts["account"]), "left_semi")
    profile = F.min(F.struct(*PROFILE)).alias("profile")
    profiles = users.groupBy("user_id").agg(profile).select(
        "user_id", *[F.col(f"profile.{c}").alias(c) for c in PROFILE]
    )
    return profiles.hint(join_hint(profiles))


def with_profiles(top: DataFrame, profiles: DataFrame, term: str) -> DataFrame:
    """Add profiles. Ranks of accounts without a profile drop out and are not refilled."""
    return top.join(profiles, top["userid"].eqNullSafe(profiles["user_id"])).select(
        *keys_of(top, term), "rank", *PROFILE, "count", *NUMBERS
    )


def collect_leaders(info: DataFrame, term: str) -> DataFrame:
    """One row per term with its users, at most ``k``, as an array in rank order."""
    user = F.struct("rank", *PROFILE, *NUMBERS)
    return info.groupBy(*keys_of(info, term)).agg(F.sort_array(F.collect_list(user)).alias("users"))


def pack(leaders: DataFrame, term: str) -> DataFrame:
    """The array as nine parallel text lists. A missing value takes an empty place, and a
    separator or a part of one at an end of a value is one space, so position i is the same user
    in every list."""
    def joined(field: str):
        values = F.col(f"users.{field}").cast("array<string>")
        shown = F.array_join(values, SEPARATOR, "")
        if field in PROFILE:
            clean = F.transform(values, lambda x: F.regexp_replace(x, r"\t,\t|^,?\t|\t,?$", " "))
            # Nothing is to be replaced in a value without a tab, which is nearly every one.
            tabbed = F.contains(F.array_join(values, ""), F.lit("\t"))
            shown = F.when(tabbed, F.array_join(clean, SEPARATOR, "")).otherwise(shown)
        return shown.alias(PACKED[field])

    return leaders.select(*keys_of(leaders, term), *[joined(c) for c in PACKED])


def unpack(packed: DataFrame, term: str) -> DataFrame:
    """One row per user from the nine text lists; ``rank`` is the position shown."""
    lists = [F.split(PACKED[c], SEPARATOR).alias(c) for c in PACKED]
    users = packed.select(term, F.arrays_zip(*lists).alias("users"))
    return users.select(term, F.posexplode("users").alias("position", "user")).select(
        term,
        (F.col("position") + 1).alias("rank"),
        *[F.col(f"user.{c}").alias(c) for c in PROFILE],
        *[F.col(f"user.{c}").try_cast("bigint").alias(c) for c in NUMBERS],
    )
