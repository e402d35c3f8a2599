"""Type-ahead: the most used terms that begin with some letters, from a sorted index of terms.

Terms lie in blocks by range, sorted; each block's first and last term and greatest count are its
fence. A prefix is a range of terms, so the fences tell the blocks it can lie in, and that a block whose
greatest count is too small for the answer needs no look.
"""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpointed, drop_folder, folder_bytes, join_hint, new_folder, read_text, write_text
from ..sources.tables import write_table

BLOCK_BYTES, MOST_BLOCKS = 16 << 20, 20_000
#: Sorts after every text that begins like it.
AFTER = "\U0010ffff"


@dataclass(frozen=True)
class Fence:
    block: int
    first: str
    last: str
    most: int


@dataclass(frozen=True)
class TermIndex:
    """An index under one folder, written once. The number of blocks is bounded, so fences are a small file."""

    root: str
    blocks: int | None = None

    def write(self, counts: DataFrame, term: str) -> None:
        """Index a table of terms and counts, each term once."""
        spark, folder = counts.sparkSession, new_folder(counts.sparkSession, "terms")
        try:
            staged = write_table(counts.select(F.col(term).alias("term"), "count"), folder)
            size = folder_bytes(spark, folder)
            blocks = self.blocks or max(1, min(MOST_BLOCKS, -(-size // BLOCK_BYTES)))
            # A large block is written by several tasks, each a range of it.
            tasks = max(1, -(-size // BLOCK_BYTES) // blocks)
            (
                staged.repartitionByRange(blocks * tasks, "term")
                .withColumn("block", F.floor(F.spark_partition_id() / tasks).cast("int"))
                .sortWithinPartitions("term").write.partitionBy("block").parquet(f"{self.root}/terms")
            )
        finally:
            drop_folder(spark, folder)
        ends = self._scan(spark).groupBy("block").agg(
            F.min("term").alias("first"), F.max("term").alias("last"), F.max("count").alias("most")
        )
        fences = [r.asDict() for r in ends.orderBy("first").collect()]  # one a block
        write_text(spark, f"{self.root}/fences", json.dumps(fences))

    def _scan(self, spark: SparkSession, *blocks: int) -> DataFrame:
        reader = spark.read.schema("term string, count bigint, block int").option("basePath", f"{self.root}/terms")
        return reader.parquet(*[f"{self.root}/terms/block={b}" for b in blocks] or [f"{self.root}/terms"])

    def fences(self, spark: SparkSession) -> list[Fence]:
        return [Fence(**f) for f in json.loads(read_text(spark, f"{self.root}/fences"))]

    def blocks_of(self, spark: SparkSession, prefix: str, n: int) -> list[int]:
        """Blocks that can hold one of the ``n`` most used terms with a prefix."""
        held = [f for f in self.fences(spark) if f.last >= prefix and f.first <= prefix + AFTER]
        # Blocks with nothing but the prefix each hold a term that is used so often.
        sure = sorted((f.most for f in held if f.first.startswith(prefix) and f.last.startswith(prefix)), reverse=True)
        least = sure[n - 1] if 0 < n <= len(sure) else 0
        return [f.block for f in held if f.most >= least]

    def complete(self, spark: SparkSession, prefix: str, n: int = 10) -> DataFrame:
        """The ``n`` most used terms that begin with a prefix, ties by term."""
        blocks = self.blocks_of(spark, prefix, n)
        if not blocks:
            return spark.createDataFrame([], "term string, count bigint")
        rows = self._scan(spark, *blocks).where(F.col("term").startswith(prefix))
        return rows.select("term", "count").orderBy(F.desc("count"), "term").limit(n)

    def complete_many(self, prefixes: DataFrame, n: int = 10) -> DataFrame:
        """prefix, place, term, count for a table of prefixes, each asked once; null prefixes and those
        without a term give no rows.

        A prefix is sent to the blocks of its range; each partition keeps its best ``n`` of a prefix
        before the shuffle, so one with very many terms is no more work for the last task than others.
        """
        spark = prefixes.sparkSession
        asked = checkpointed(prefixes.where(F.col("prefix").isNotNull()).select("prefix").distinct())
        fences = spark.createDataFrame(
            [(f.block, f.first, f.last) for f in self.fences(spark)], "block int, first string, last string"
        )
        # At most MOST_BLOCKS rows of two terms, so the comparisons of a prefix are bounded too.
        inside = (F.col("last") >= F.col("prefix")) & (F.col("first") <= F.concat("prefix", F.lit(AFTER)))
        sent = checkpointed(asked.join(F.broadcast(fences), inside).select("block", "prefix"))
        opened = [r["block"] for r in sent.select("block").distinct().collect()]
        if not opened:
            return spark.createDataFrame([], "prefix string, place int, term string, count bigint")
        found = self._scan(spark, *opened).join(sent.hint(join_hint(sent)), "block")
        found = found.where(F.col("term").startswith(F.col("prefix")))
        order = Window.partitionBy("prefix").orderBy(F.desc("count"), "term")
        ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
        return ranked.select("prefix", "place", "term", "count")
