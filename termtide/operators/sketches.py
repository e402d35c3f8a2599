"""Distinct accounts of a term, by sketches that merge: over months, and of batch and stream.

HyperLogLog sketches of 2**14 registers: the relative standard error is 0.8 %, and small sets are counted
almost exactly. Sketches are binary columns, so a table of them is kept and added to like any view.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 14
#: Relative errors stay below this, four standard errors.
BOUND = 0.033


def accounts_by_month(rows: DataFrame, term: str) -> DataFrame:
    """Per term and month a sketch of the accounts that used it. Rows without an account add none."""
    return rows.groupBy(term, "tweet_month").agg(F.hll_sketch_agg("userid", LOG_REGISTERS).alias("accounts"))


def merged(*sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch per key of all that have it: over months if they are no key, over tables if there
    are several."""
    rows = sketches[0]
    for more in sketches[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*keys).agg(F.hll_union_agg("accounts").alias("accounts"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketch replaced by its estimate."""
    return sketches.withColumn("accounts", F.hll_sketch_estimate("accounts"))
