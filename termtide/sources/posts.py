"""Posts: raw CSV scan and the clean typed table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import blank_to_null, parse_list
from ..schemas import POST_TYPES, RAW_POST_SCHEMA


def scan_posts_csv(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """The 31 columns as text. Quoted fields may hold commas, quotes and line breaks.

    A file with line breaks inside quotes cannot be split, so each file is one task:
    hand in many files. With ``multi_line=False`` files split at any line end, for
    exports known to have none inside quotes.
    """
    return spark.read.csv(
        path, schema=RAW_POST_SCHEMA, header=True, sep=",", quote='"', escape='"',
        multiLine=multi_line,
    )


def normalize_posts(raw: DataFrame) -> DataFrame:
    """Blank text and empty lists become NULL, the rest is cast; a value that does not
    cast is NULL. Account columns are dropped. Takes any subset of the post columns."""

    def clean(column: str, kind: str):
        text = F.col(column)
        if kind == "array<string>":
            return parse_list(text).alias(column)
        return blank_to_null(text).try_cast(kind).alias(column)

    return raw.select(*[clean(c, t) for c, t in POST_TYPES.items() if c in raw.columns])
