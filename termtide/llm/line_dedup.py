"""Lines that many documents share are taken out of all but one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.tables import BLANKS, fresh, hinted, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case.

    ``lower`` does that for ASCII, and is much faster than ``translate`` by character.
    """
    stripped = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, UPPER.lower()))


def dedup_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with shared lines taken out of the text, and n_lines, n_dropped (long).

    Lines are what "\\n" parts; a null or empty text is one empty line, and the text of a row
    always comes back as a string. A line's key is the line stripped of ASCII blanks with A-Z in
    lower case. A key of ``min_chars`` code points or more, found in ``min_docs`` ids or more, loses
    its lines everywhere but in the largest id that holds it, where all of them stay. Rows of one
    id are one document. A null id is an id below all others. Other columns are kept, whatever their
    names; ones named n_lines or n_dropped give way.

    The exploded lines are written once as (id, text hash, position, line hash), without text. A
    hot line counts as one row per task and id; in the join that finds its places AQE can split it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = written(
        docs.select(
            F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"),
            F.posexplode(F.split(text, "\n")).alias("at", "line"),
        )
        .select("doc", "version", "at", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "version", "at", F.unhex(F.md5("key")).alias("key")),
        "lines",
    )
    shared = (
        lines.groupBy("key")
        .agg(F.count_distinct(F.struct("doc")).alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("key", "keeper")
    )
    dropped = (
        lines.join(hinted(written(shared, "shared-lines")), "key")
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version")
        .agg(F.collect_list("at").alias("places"))
    )
    version, doc, of, at = fresh(docs, "version", "doc", "of", "places")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc)) & (F.col(version) == F.col(of))
    joined = docs.withColumn(version, F.xxhash64(text)).join(dropped.toDF(doc, of, at), same, "left")
    parts, places = F.split(text, "\n"), F.col(at)
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    kept = F.array_except(every, places)
    again = F.array_join(F.transform(kept, lambda at: F.get(parts, at)), "\n")
    whole = places.isNull()
    kept_names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return joined.select(
        *(F.when(whole, text).otherwise(again).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept_names),
        F.size(parts).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size(F.array_distinct(places))).cast("long").alias("n_dropped"),
    )


def drop_shared_lines(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """`dedup_lines` with the columns of ``docs`` alone; a column of the text's length follows it."""
    found = dedup_lines(docs, text_col=text_col, **options)
    length = F.char_length(F.col(text_col)).cast("long")
    return found.select(
        *(length.alias(c) if c == chars_col else F.col(f"`{c}`") for c in docs.columns)
    )
