"""Documents taken so that sources reach target shares of all words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.tables import fresh, WORD, hinted, written

HASH_BITS = 60
LEVEL_BITS = 12
LEVELS = 3


def hash_of(id_col: str) -> Column:
    """The first 60 bits of the MD5 of the id as text; of a null, 0."""
    first = F.left(F.md5(F.col(id_col).cast("string")), F.lit(HASH_BITS // 4))
    return F.coalesce(F.conv(first, 16, 10).cast("long"), F.lit(0))


def sizes_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc, source, size (words of the text; null: 0) and a hash of the id."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
    return docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"), words.cast("long").alias("size"),
        hash_of(id_col).alias("hash"),
    )


def targets_of(sizes: DataFrame, weights=(1, 2, 3), most: int = 3) -> DataFrame:
    """Per source: source_size, target, whole (full repeats) and rest (words beyond them).

    Sources, ordered by code point with null last, take the weights in turn and share the words
    of all. A target stops at ``most`` times its source's size, what is over goes to the others by
    weight. Ordered by limit per weight, the sources at their limit come first, so running sums
    find them in one pass.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights)) + 1)
    limit = F.lit(float(most)) * F.col("source_size")
    sources = sources.withColumn("weight", pick.cast("double")).withColumn("limit", limit)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sources = sources.select(
        "*",
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("limits_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
        F.sum("source_size").over(every).cast("double").alias("total"),
        F.sum("weight").over(every).alias("weights"),
    )
    share = F.col("total") - F.col("limits_before")
    left = F.col("weights") - F.col("weights_before")
    sources = sources.withColumn("full", share * F.col("weight") >= F.col("limit") * left)
    open_ = Window.partitionBy("full").orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    first = lambda c: F.first(c).over(open_.rowsBetween(Window.unboundedPreceding, 0))
    target = F.when(F.col("full"), F.col("limit")).otherwise(
        first(share) * F.col("weight") / first(left)
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        sources.withColumn("target", target)
        .withColumn("whole", F.coalesce(whole, F.lit(0)))
        .select(
            "source", "source_size", "target", "whole",
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        )
    )


def thresholds_of(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source, the hash up to which documents give one repeat more to reach the rest.

    Words are summed by source and hash bucket; only the bucket in which the budget ends is
    summed again by finer buckets, and at last by hash. The document at the edge is in if that
    comes nearer to the target. Rows of one hash are in or out together.
    """
    open_ = targets.where(F.col("rest") > 0).select("source", F.col("rest").alias("left"))
    part = open_.withColumn("bucket", F.lit(0).cast("long"))
    shift = HASH_BITS
    for level in range(LEVELS + 1):
        last = level == LEVELS
        up, shift = shift, 0 if last else shift - LEVEL_BITS
        inside = sizes if not level else sizes.withColumn("above", F.shiftright("hash", up))
        narrowed = hinted(part.select(F.col("source").alias("of"), "left", "bucket"))
        match = F.col("source").eqNullSafe(F.col("of"))
        if level:
            match &= F.col("above") == F.col("bucket")
        sums = (
            inside.join(narrowed, match)
            .groupBy("source", F.shiftright("hash", shift).alias("fine"))
            .agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        )
        order = Window.partitionBy("source").orderBy("fine")
        sums = sums.withColumn(
            "before",
            F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        if last:
            nearer = 2 * (F.col("left") - F.col("before")) >= F.col("words")
            return (
                sums.where((F.col("before") < F.col("left")) & nearer)
                .groupBy("source").agg(F.max("fine").alias("upto"))
                .join(
                    part.select(
                        F.col("source").alias("of"),
                        (F.shiftleft("bucket", up) - 1).alias("below"),
                    ),
                    F.col("source").eqNullSafe(F.col("of")), "right",
                )
                .select(F.col("of").alias("source"), F.coalesce("upto", "below").alias("upto"))
            )
        edge = sums.where(
            (F.col("before") < F.col("left")) & (F.col("before") + F.col("words") >= F.col("left"))
        )
        part = written(
            edge.select("source", F.col("fine").alias("bucket"), (F.col("left") - F.col("before")).alias("left")),
            "mix-edges",
        )


def mix_sizes(
    docs: DataFrame, weights=(1, 2, 3), most: int = 3, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per row: doc, source, size, source_size (long), target (double), copies and taken (long).

    ``copies`` is how often the mix holds the document, at most ``most``; ``taken`` is copies
    times size. Which documents are taken once more than the others of their source hangs on a
    hash of the id alone, so reruns agree and a larger budget holds a smaller one's documents.
    Rows of one id are taken or left together; rows with a null id too. A null source is a source.
    Empty documents have copies as their hash says and take nothing; a source without words has
    target 0. An empty table gives no rows. Other columns are not read.
    """
    sizes = written(sizes_of(docs, id_col, text_col, source_col), "mix-sizes")
    targets = written(targets_of(sizes, weights, most), "mix-targets")
    upto = thresholds_of(sizes, targets)
    plan = written(
        targets.join(
            upto.select(F.col("source").alias("of"), "upto"),
            F.col("source").eqNullSafe(F.col("of")), "left",
        ).select(F.col("source").alias("of"), "source_size", "target", "whole", "upto"),
        "mix-plan",
    )
    more = F.coalesce((F.col("hash") <= F.col("upto")).cast("long"), F.lit(0))
    copies = F.least(F.col("whole") + more, F.lit(most)).cast("long")
    return sizes.join(hinted(plan), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc", "source", "size", "hash", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame, weights=(1, 2, 3), most: int = 3, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that the mix holds, each as often as it is taken; see `mix_sizes`.

    The rows are filtered where they lie: by source, hash of the id and word count of nothing
    but themselves, without a shuffle of texts if the table of sources is small.
    """
    sizes = written(sizes_of(docs, id_col, text_col, source_col), "mix-sizes")
    targets = written(targets_of(sizes, weights, most), "mix-targets")
    of, whole, upto, n, one = fresh(docs, "of", "whole", "upto", "copies", "copy")
    plan = written(
        targets.join(
            thresholds_of(sizes, targets).select(F.col("source").alias("of"), "upto"),
            F.col("source").eqNullSafe(F.col("of")), "left",
        ).select(F.col("source").alias(of), F.col("whole").alias(whole), F.col("upto").alias(upto)),
        "mix-plan",
    )
    more = F.coalesce((hash_of(id_col) <= F.col(upto)).cast("long"), F.lit(0))
    copies = F.least(F.col(whole) + more, F.lit(most)).cast("int")
    rows = docs.join(hinted(plan), F.col(f"`{source_col}`").eqNullSafe(F.col(of)))
    return (
        rows.withColumn(n, copies).where(F.col(n) > 0)
        .withColumn(one, F.explode(F.sequence(F.lit(1), F.col(n))))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
