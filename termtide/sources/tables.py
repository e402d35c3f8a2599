"""Named tables, append and overwrite sinks, and the serving store."""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lead_of
from ..functions.values import serving_key
from ..session import drop_folder, folder_bytes, parts_for, term_files, written_as_it_lies, written_once

_RELEASE = "name string, path string, buckets int, counted bigint"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Write a columnar table at a path and return a scan of it."""
    with written_once(df.sparkSession):
        df.write.mode(mode).format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Write a catalog table (``overwrite`` or ``append``) and return a scan of it."""
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if path:
        writer = writer.option("path", path)
    with written_once(df.sparkSession):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@dataclass(frozen=True)
class View:
    """One written version of a view: where it is, and by how many buckets it is laid out."""

    name: str
    path: str
    buckets: int

    def bucket(self, term: Column) -> Column:
        """By the first words of the term, as Spark deals rows out by them, so that n-grams dealt out by
        those into a multiple of the buckets have one bucket a partition."""
        return F.pmod(F.hash(lead_of(term)), F.lit(self.buckets)).cast("int")

    def scan(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


@dataclass(frozen=True)
class ViewStore:
    """Published views, laid out for lookups by term.

    A view is partitioned by a hash bucket of the term and sorted by term inside each
    file. A lookup of one term opens one bucket folder and, by the Parquet minimum and
    maximum of the sorted term column, few row groups; a join with a table of terms
    prunes the folders at run time. The bucket count follows from the measured size of
    the view unless one is given.

    Each write goes to a folder of its own. A release is a small table that names the
    folder and layout of every view and the last counter batch they hold; readers take the
    newest that was written to the end, so they see all of a build or none of it. The
    folders of the release before stay, for readers that have begun; older ones are dropped.
    """

    root: str
    buckets: int | None = None
    files_per_bucket: int = 1
    file_bytes: int = 256 << 20

    @classmethod
    def for_size(cls, root: str, view_bytes: int, file_bytes: int = 256 << 20) -> "ViewStore":
        """A fixed layout whose files come out at about ``file_bytes`` each."""
        files = max(1, -(-view_bytes // file_bytes))
        buckets = min(1024, max(32, files))
        return cls(root, buckets, -(-files // buckets))

    def layout(self, view_bytes: int, cores: int) -> tuple[int, int]:
        """Buckets and files per bucket; a small view is still written by all cores."""
        if self.buckets:
            return self.buckets, self.files_per_bucket
        files = max(1, -(-view_bytes // self.file_bytes), min(cores, view_bytes >> 22))
        buckets = min(1024, files)
        return buckets, -(-files // buckets)

    def write(self, view: DataFrame, name: str, term: str) -> View:
        """Write a version of a view that no reader sees before it is released.

        The view is first written as it comes, which is what its size is measured on and what
        a lost executor repeats from, then dealt out and sorted. Views hold few rows per term
        (its months, or one), so hashed buckets come out even however often a term is used.

        A view whose n-grams were dealt out by their first words (``_lead``) is written as it lies, a
        partition to a bucket; how many buckets follows from what the view is read from. It is sorted by those
        words and the term, which is the order of terms, as no character of a word comes before a blank.
        """
        spark, path = view.sparkSession, f"{self.root}/views/{name}-{uuid.uuid4().hex}"
        staged = f"{path}-staged"
        if "_lead" in view.columns:
            written = View(name, path, self.buckets or min(1024, parts_for(view)))
            try:
                with written_as_it_lies(spark):
                    (
                        view.withColumn("bucket", written.bucket(F.col(term))).sortWithinPartitions("_lead", term)
                        .drop("_lead").write.options(**term_files(term)).partitionBy("bucket").parquet(path)
                    )
            except BaseException:
                drop_folder(spark, path)
                raise
            return written
        try:
            if not self.buckets:
                view = write_table(view, staged)
            size = 0 if self.buckets else folder_bytes(spark, staged)
            buckets, files = self.layout(size, spark.sparkContext.defaultParallelism)
            written = View(name, path, buckets)
            file_of = F.pmod(F.xxhash64(F.col(term), F.lit("file")), F.lit(files))
            with written_once(spark):
                (
                    view.withColumn("bucket", written.bucket(F.col(term)))
                    .repartition(max(buckets * files, 1), "bucket", file_of)
                    .sortWithinPartitions("bucket", term)
                    .write.options(**term_files(term)).partitionBy("bucket").parquet(path)
                )
        except BaseException:
            drop_folder(spark, path)
            raise
        finally:
            drop_folder(spark, staged)
        return written

    def release(self, spark: SparkSession, views: list[View], counted: int | None) -> None:
        """Show these views, and of the others what is shown now, to readers from now on.
        ``counted`` is the last counter batch whose posts they hold; None: they hold none."""
        known = self._releases(spark)
        shown = {v.name: v for v in [*self._views(spark, known[-1]), *views]} if known else {
            v.name: v for v in views
        }
        rows = [(v.name, v.path, v.buckets, counted) for v in shown.values()]
        number = known[-1] + 1 if known else 0
        spark.createDataFrame(rows, _RELEASE).coalesce(1).write.mode("overwrite").parquet(
            self._release(number)
        )
        held = {v.path for n in [*known[-1:], number] for v in self._views(spark, n)}
        for old in known[:-1]:
            for view in self._views(spark, old):
                if view.path not in held:
                    drop_folder(spark, view.path)
            drop_folder(spark, self._release(old))

    def publish(self, view: DataFrame, name: str, term: str) -> None:
        """Write and release one view."""
        spark = view.sparkSession
        self.release(spark, [self.write(view, name, term)], self.mark(spark))

    def open(self, spark: SparkSession, name: str) -> View:
        """The version of a view that readers see now."""
        known = self._releases(spark)
        for view in self._views(spark, known[-1]) if known else []:
            if view.name == name:
                return view
        raise LookupError(f"no view {name} has been released in {self.root}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.open(spark, name).scan(spark)

    def mark(self, spark: SparkSession) -> int | None:
        """The last counter batch whose posts the views hold."""
        known = self._releases(spark)
        if not known:
            return None
        return spark.read.schema(_RELEASE).parquet(self._release(known[-1])).first()["counted"]

    def _release(self, number: int) -> str:
        return f"{self.root}/releases/release={number}"

    def _releases(self, spark: SparkSession) -> list[int]:
        """Numbers of the releases written to the end; two at most but for a lost clean-up."""
        marks = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/releases/release=*/_SUCCESS")
        found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _views(self, spark: SparkSession, number: int) -> list[View]:
        rows = spark.read.schema(_RELEASE).parquet(self._release(number)).collect()
        return [View(r["name"], r["path"], r["buckets"]) for r in rows]


def keyed_by_month(view: DataFrame, term: str) -> DataFrame:
    """A month view in its serving form: ``term_month`` key and the seven columns."""
    return view.select(serving_key(F.col(term), F.col("tweet_month")).alias("key"), "*")
