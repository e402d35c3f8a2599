"""Cascades: each post's root, through what it replies to, quotes or repeats, and sums to the root."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import COUNTS
from ..session import drop_folder, new_folder
from ..sources.tables import write_table

#: Which one counts if a post has several: the post it repeats, then quotes, then replies to.
PARENTS = ("retweet_tweetid", "quoted_tweet_tweetid", "in_reply_to_tweetid")


def roots(posts: DataFrame, key: str = "tweetid", parents=PARENTS) -> DataFrame:
    """Per post: its id, root and depth, by pointer doubling.

    The root is the last post of the chain that is there; a parent that is not there ends it, so a reply
    to a lost post is a root of depth 0. Posts in a cycle, and those that lead to one, have a null root and depth.
    Posts without an id are left out; of rows of one id the least parent counts.

    Each round joins every open pointer with the pointer it points to, so chains of length n take
    log n rounds. A post to which very many point is a hot key of one side only: AQE cuts it.
    """
    spark, folders = posts.sparkSession, []

    def kept(rows):
        folders.append(new_folder(spark, "cascades"))
        return write_table(rows, folders[-1])

    known = posts.where(F.col(key).isNotNull())
    up = known.select(F.col(key).alias("id"), F.coalesce(*[F.nullif(p, F.lit("")) for p in parents]).alias("up"))
    up = up.groupBy("id").agg(F.min("up").alias("up"))
    there = up.select(F.col("id").alias("up"))
    # A pointer to a post that is there; ``on`` is its end so far and ``depth`` how far that is.
    linked = up.join(there.hint("merge"), "up", "left_semi").select("id", F.col("up").alias("on"), F.lit(1).cast("long").alias("depth"))
    now = kept(linked)
    posts_there = up.count()
    while True:
        step = now.select(F.col("id").alias("on"), F.col("on").alias("next"), F.col("depth").alias("more"))
        found = now.join(step.hint("merge"), "on", "left").select(
            "id", F.coalesce("next", "on").alias("on"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        # Longer than all posts is round and round.
        found = kept(found.where(F.col("depth") <= posts_there))
        if found.where("moved").isEmpty():
            break
        now = found.drop("moved")
        if len(folders) > 2:
            drop_folder(spark, folders.pop(-3))
    ends = found.select("id", F.col("on").alias("root"), "depth")
    result = up.join(ends.hint("merge"), "id", "left").join(
        linked.select("id", F.lit(True).alias("linked")).hint("merge"), "id", "left"
    )
    top = F.col("linked").isNull()
    return result.select(
        F.col("id").alias(key), F.when(top, F.col("id")).otherwise(F.col("root")).alias("root"),
        F.when(top, F.lit(0)).otherwise(F.col("depth")).alias("depth"),
    )


def cascade_totals(posts: DataFrame, found: DataFrame, key: str = "tweetid") -> DataFrame:
    """Per root: posts, the greatest depth, and reactions summed over all its posts. Posts in cycles are
    in none."""
    rows = posts.select(key, *COUNTS).join(found.where(F.col("root").isNotNull()).hint("merge"), key)
    return rows.groupBy("root").agg(
        F.count("*").alias("posts"), F.max("depth").alias("depth"), *[F.sum(c).alias(f"total_{c}") for c in COUNTS]
    )
