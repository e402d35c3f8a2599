"""As-of join: each post with the version of its account that was valid at its time."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, join_hint

#: Accounts with more posts and versions than this are cut into time ranges of about so many.
MOST = 1_000_000


def hot_ranges(keyed: DataFrame, most: int) -> DataFrame:
    """key, bounds: where to cut the time of keys that have more than ``most`` rows."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    counts = checkpointed(counts)
    if counts.isEmpty():
        return counts.select("key", F.array(F.lit(None).cast("timestamp")).alias("bounds"))
    hot = keyed.join(counts.hint(join_hint(counts)), "key")
    # A sketch of the times, in a thousand steps at most; where few times make many rows, equal bounds are one.
    steps = F.least(F.lit(1000), F.ceil(F.max("n") / most)).cast("int")
    at = F.percentile_approx("micros", [i / 1000 for i in range(1, 1000)], 10_000)
    cuts = hot.groupBy("key").agg(at.alias("at"), steps.alias("steps"))
    picked = F.expr("transform(sequence(1, steps - 1), i -> timestamp_micros(at[cast(floor(i * 999 / steps) as int)]))")
    return checkpointed(cuts.select("key", F.array_distinct(F.array_sort(picked)).alias("bounds")))


def as_of(
    posts: DataFrame, versions: DataFrame, fields: Sequence[str], key: str = "userid", time: str = "tweet_time",
    version_key: str = "user_id", valid_from: str = "valid_from", most: int = MOST,
) -> DataFrame:
    """``posts`` with ``fields`` of the newest version of their key that is not newer than the post.

    Posts before the first version, without a key or a time, or of an unknown key have nulls. Of versions of one time the
    greatest counts, compared field by field. Versions without a key or time are never valid.

    Posts and versions are united and put in order of time; the last version so far is the valid one.
    An account with more than ``most`` rows is cut into ranges of its time, each a group of its own; what
    was valid where a range begins is found from one row per range and put in front of it.
    """
    profile = F.struct(*fields)
    version = versions.where(F.col(version_key).isNotNull() & F.col(valid_from).isNotNull()).groupBy(
        F.col(version_key).alias("key"), F.col(valid_from).cast("timestamp").alias("time")
    ).agg(F.max(profile).alias("profile"))
    whole = F.struct(*[F.col(f"`{c}`") for c in posts.columns])
    post = posts.select(F.col(key).alias("key"), F.col(time).cast("timestamp").alias("time"), whole.alias("post"))
    never = F.col("key").isNull() | F.col("time").isNull()

    micros = F.unix_micros("time").alias("micros")
    keyed = version.select("key", micros).unionByName(post.where(~never).select("key", micros))
    bounds = hot_ranges(keyed, most)
    ranged = [_in_ranges(rows, bounds) for rows in (version, post.where(~never))]

    # What is valid where a range begins: the last version of an earlier range.
    last = ranged[0].groupBy("key", "range").agg(F.max_by("profile", "time").alias("profile"))
    needed = ranged[1].where(F.col("range") > 0).select("key", "range").distinct()
    before = last.unionByName(needed.withColumn("profile", F.lit(None).cast(last.schema["profile"].dataType)))
    before = before.groupBy("key", "range").agg(F.max("profile").alias("profile"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("key", "range", F.last("profile", ignorenulls=True).over(earlier).alias("profile"))
    before = before.where(F.col("profile").isNotNull() & (F.col("range") > 0))

    nothing = F.lit(None).cast(post.schema["post"].dataType).alias("post")
    no_profile = F.lit(None).cast(last.schema["profile"].dataType).alias("profile")
    rows = (
        before.select("key", "range", F.lit(None).cast("timestamp").alias("time"), F.lit(0).alias("turn"), "profile", nothing)
        .unionByName(ranged[0].select("key", "range", "time", F.lit(1).alias("turn"), "profile", nothing))
        .unionByName(ranged[1].select("key", "range", "time", F.lit(2).alias("turn"), no_profile, "post"))
    )
    # A missing time sorts first. At one time versions come before posts.
    order = Window.partitionBy("key", "range").orderBy("time", "turn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    valid = rows.withColumn("profile", F.last("profile", ignorenulls=True).over(order)).where("turn = 2")
    both = valid.select("post", "profile").unionByName(post.where(never).select("post", no_profile))
    kept = [c for c in posts.columns if c not in fields]
    return both.select(*[F.col(f"post.`{c}`") for c in kept], *[F.col(f"profile.{f}").alias(f) for f in fields])


def _in_ranges(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """``rows`` with the number of the time range they are in; 0 for keys that aren't cut."""
    found = rows.join(bounds.hint(join_hint(bounds)), "key", "left")
    number = F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col("time"))), F.lit(0))
    return found.withColumn("range", F.when(F.col("bounds").isNull(), 0).otherwise(number)).drop("bounds")
