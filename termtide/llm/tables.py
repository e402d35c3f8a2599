"""Tables between the steps of an operator, and how small ones are joined."""

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.session import join_hint, new_folder

#: Bytes; both blanks between words and what lines are stripped of. Fixed values.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a Parquet table in the folder all executors share.

    It cuts the lineage: a lost executor costs the tasks that ran on it, not the steps before.
    """
    spark = rows.sparkSession
    path = new_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system. Python workers are used again and stay side by side, and each
    would go on holding the most it ever had."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def hinted(rows: DataFrame) -> DataFrame:
    """A side of a join that is broadcast only if its values, measured, are small."""
    return rows.hint(join_hint(rows))


def fresh(rows: DataFrame, *names: str) -> list[str]:
    """The names, or ones like them, that no column of ``rows`` has, in any case."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out
