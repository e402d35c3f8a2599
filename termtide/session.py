"""Where intermediate and published tables go."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folder = None
#: Files that a task has open at once where what it writes isn't sorted by them.
FEW_FILES = 4


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="termtide-")
    return _local_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so runs cannot collide."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that `new_folder` made room for."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from the file system's listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder)
    return found.getLength()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which readers see whole or not at all. Fails if there is one of that name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final, begun = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(begun, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(final) or not system.rename(begun, final):
        system.delete(begun, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows, evaluated once and kept in the shared folder: for a small table that several parts
    of a plan need. Spark drops the files with the DataFrame where its cleaner is told to."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def settings(input_bytes: int, cores: int, task_bytes: int = 128 << 20) -> dict[str, str]:
    """Session settings for an input of that many bytes on that many cores.

    N-grams of four sizes repeat every word about fourteen times, map-side
    counting takes some of that back; ten times the input is a safe shuffle
    estimate. AQE merges what turns out too small.
    """
    partitions = max(cores, -(-10 * input_bytes // task_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Users of a term are collected from rows that are sorted by term already.
        "spark.sql.execution.replaceHashWithSortAgg": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def parts_of(size: int, least: int, part_bytes: int = 4 << 20, most: int = 1 << 14) -> int:
    """A power of two, by bytes."""
    return 1 << (min(most, max(1, least, -(-size // part_bytes))) - 1).bit_length()


def parts_for(rows: DataFrame, part_bytes: int = 4 << 20, most: int = 1 << 14) -> int:
    """Into how many parts to deal what becomes of ``rows``: a power of two, by the bytes of the files and kept
    tables they are read from, and not less than the session's shuffle partitions.

    Spark's own estimates and AQE look at the bytes of a shuffle; here a part is to hold what its rows are exploded to.
    """
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(s for s in sizes if s < 1 << 60)  # what Spark can't tell the size of has the greatest there is
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts_of(size, least, part_bytes, most)


def spread(rows: DataFrame, key: str, tasks_per_core: int = 2) -> DataFrame:
    """Deal a small scan out over all cores, by hash of ``key``.

    A file comes in as many tasks as it has splits, one if it is CSV with line breaks in
    quotes, so a table of few files can leave most cores without work. What comes in one
    partition per core or more, and what has been shuffled, is returned as it is: there
    the extra shuffle would cost more than it gives.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    plan = rows._jdf.queryExecution().executedPlan().toString()
    if re.search(r"(?<!Broadcast)Exchange", plan) or rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(tasks_per_core * cores, key)


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def joined_as_laid_out(spark: SparkSession) -> AbstractContextManager[None]:
    """Sides of a join that are laid out alike by some of its keys are not shuffled by all of them, in what is
    planned meanwhile."""
    return _set(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"})


def written_once(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written, or planned and collected, meanwhile gives the disk of its shuffles back when that is done, not
    whenever the driver happens to collect its garbage: a plan of many tables takes the disk of its largest step, not
    of all."""
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def written_as_it_lies(spark: SparkSession) -> AbstractContextManager[None]:
    """As `written_once`, for rows of which a task has a few folders or buckets at most: they are written in the order
    they are in. Spark else sorts them by the hash of their bucket, which it works out for every comparison. What is
    collected from sorted rows isn't sorted again."""
    return _set(spark, {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.replaceHashWithSortAgg": "true",
        "spark.sql.maxConcurrentOutputFileWriters": str(FEW_FILES),
    })


def term_files(term: str, *more: str) -> dict[str, str]:
    """Options of Parquet files that are sorted by a term: a term is stored as what differs from the one before."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in (term, *more)}
    return {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", **plain}


def join_hint(rows: DataFrame, limit: int = 64 << 20) -> str:
    """``broadcast`` if the values of a table, measured, take at most ``limit`` bytes, else
    ``merge``, a sort-merge join in which AQE splits hot keys.

    With either hint the other side is never broadcast. Left to its estimates Spark might:
    it does not see that an exploded text is many times the size of its files.
    """
    width = F.lit(0)
    for column in rows.columns:
        width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + 16
    taken = rows.agg(F.sum(width)).first()[0] or 0
    return "broadcast" if taken <= limit else "merge"
