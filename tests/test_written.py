"""What writing leaves on the disk: no shuffles, and files in which a term is kept as what differs from the one before."""

import subprocess
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termtide.operators import leaders, terms
from termtide.operators.usage import usage_by_month
from termtide.plans.incremental import Totals
from termtide.session import new_folder
from termtide.sources.tables import ViewStore, save_table, write_table
from termtide.streaming.counters import CounterLog


def shuffles(spark):
    """Shuffle files of this session."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(f.getAbsolutePath()) for f in manager.localDirs()]
    found = subprocess.run(["find", *folders, "-name", "shuffle_*.data"], capture_output=True, text=True).stdout
    return set(found.split())


@pytest.mark.parametrize("way", ["table", "saved", "view", "totals", "counters"])
def test_shuffles_go_when_a_table_is_written(spark, post, way):
    posts = post({}, {"tweetid": "2", "userid": "u2", "tweet_text": "red fox runs far"}, {"tweetid": "3", "hashtags": ["x"]})
    rows, path = usage_by_month(terms.ngram_rows(posts, dealt=True), "ngram"), new_folder(spark, "written")
    before = shuffles(spark)
    write = {
        "table": lambda: write_table(rows, path),
        "saved": lambda: save_table(rows, "termtide_test_written", path=path),
        "view": lambda: ViewStore(path).write(rows, "months", "ngram"),
        "totals": lambda: Totals(path, buckets=2).build(posts),
        "counters": lambda: CounterLog(path).add(posts, 0),
    }
    write[way]()
    # Totals gather small tables beside what they write, by ordinary jobs.
    left = [f for f in shuffles(spark) - before if Path(f).stat().st_size > 0]
    assert not left
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name) == "false"


def files(path):
    return sorted(f for f in Path(path).rglob("*.parquet") if pq.ParquetFile(f).metadata.num_rows)


def held_as_differences(file, column):
    rows = pq.ParquetFile(file).metadata.row_group(0)
    chunk = next(rows.column(i) for i in range(rows.num_columns) if rows.column(i).path_in_schema == column)
    return chunk.compression == "ZSTD" and "DELTA_BYTE_ARRAY" in chunk.encodings


def test_terms_are_kept_in_order_as_differences(spark, post):
    posts = post({"tweet_text": "red fox runs far over hills"}, {"userid": "u2", "tweet_text": "blue whale swims far"})
    totals, view = Totals(new_folder(spark, "totals"), buckets=2), ViewStore(new_folder(spark, "views"), buckets=2)
    totals.build(posts)
    totals.apply(posts.withColumn("sign", F.lit(1)))
    rows = usage_by_month(terms.ngram_rows(posts, dealt=True), "ngram")
    log = CounterLog(new_folder(spark, "counters"))
    log.add(posts, 0)
    places = [(t.path, "term") for n, t in totals.tables(spark).items() if n.startswith("ngram")]
    places += [(view.write(rows, "months", "ngram").path, "ngram"), (f"{log.root}/counts/batch_id=0/kind=ngram", "term")]
    for path, term in places:
        assert files(path)
        for file in files(path):
            held = pq.ParquetFile(file).read(columns=[term])[term].to_pylist()
            assert held == sorted(held) and held_as_differences(file, term), file


def test_only_values_with_a_tab_are_cleaned(spark):
    """The same lists whether a term has such values or not."""
    user = {"rank": 1, **{c: "x" for c in leaders.PROFILE}, **{c: 1 for c in leaders.NUMBERS}}
    fields = ["rank:int", *[f"{c}:string" for c in leaders.PROFILE], *[f"{c}:bigint" for c in leaders.NUMBERS]]
    rows = spark.createDataFrame([
        ("plain", [user, {**user, "rank": 2, "user_display_name": None}]),
        ("tabs", [{**user, "user_display_name": ",\ta\t,\tb\t"}, user]),
    ], f"ngram string, users array<struct<{','.join(fields)}>>")
    packed = leaders.pack(rows, "ngram")
    got = {r.ngram: r.user_display_names for r in packed.collect()}
    assert got == {"plain": "x\t,\t", "tabs": " a b \t,\tx"}
    assert "CASE WHEN" in packed._jdf.queryExecution().optimizedPlan().toString()
