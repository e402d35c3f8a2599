"""Connected components of a graph given by its edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.tables import written


def roots(pairs) -> dict[int, int]:
    """Union-find: each node that is not the least of its set, with that least one."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def thinned(edges: DataFrame) -> DataFrame:
    """Each task replaces its edges by stars of the same components, at most one edge a node."""

    def joined(batches):
        def pairs():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        found = roots(pairs())
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], ["a", "b"]
        )

    return edges.mapInArrow(joined, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node it is connected to) of every node that isn't the least.

    ``edges`` has two columns of nodes (long). Large-star and small-star steps by turns until
    nothing changes: each hangs neighbours on the least node near them, by a minimum with a map
    side and a join in which AQE can split a hot node. The number of steps grows with the logarithm
    of the longest path. No edges give no rows; self-loops and repeated edges are ignored.
    """
    a, b = edges.columns
    now = written(
        thinned(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == state or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(seen)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = written(
            small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), "edges"
        )
