"""Accounts: CSV scan by header name and the users dimension."""

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.accounts import created_on, language_name
from ..functions.values import blank_to_null
from ..schemas import RAW_USER_COLUMNS


def scan_users_csv(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """The 10 account columns as text, found by header name in whatever order.

    Files need not agree in their order: one pass finds the header row of each file, and
    files of one header are one scan.
    """
    options = {"sep": ",", "quote": '"', "escape": '"', "multiLine": multi_line}
    header = F.split(F.regexp_replace("value", '["\ufeff\r]', ""), ",")
    is_header = F.size(F.array_intersect("header", F.lit(RAW_USER_COLUMNS))) == len(RAW_USER_COLUMNS)
    headers = (
        spark.read.text(path).select(F.input_file_name().alias("file"), header.alias("header")).where(is_header)
        .groupBy("header").agg(F.collect_set("file").alias("files")).orderBy("header").collect()
    )
    if not headers:
        raise ValueError(f"no file at {path} has all account columns in its header")
    scans = [
        spark.read.csv([unquote(f) for f in h["files"]], header=True, **options).select(*RAW_USER_COLUMNS)
        for h in headers
    ]
    return reduce(DataFrame.unionByName, scans)


def users_dimension(raw: DataFrame) -> DataFrame:
    """One typed row per account row. An unknown language or a malformed date leaves a
    NULL in its place and keeps the row; a blank follower count is 0."""

    def number(column: str):
        blank = F.coalesce(F.trim(column), F.lit("")) == ""
        return F.when(blank, 0).otherwise(F.col(column).try_cast("int")).alias(column)

    created = created_on(F.col("account_creation_date"))
    return raw.select(
        F.col("userid").alias("user_id"),
        "user_display_name",
        "user_screen_name",
        *[
            blank_to_null(F.col(c)).alias(c)
            for c in ("user_reported_location", "user_profile_description", "user_profile_url")
        ],
        number("follower_count"),
        number("following_count"),
        F.year(created).cast("short").alias("account_creation_year"),
        F.month(created).cast("byte").alias("account_creation_month"),
        F.day(created).cast("byte").alias("account_creation_day"),
        language_name(F.col("account_language")).alias("account_language"),
    )


def user_rejects(users: DataFrame) -> DataFrame:
    """How many account rows lost a required field in the load, by field."""
    required = [
        "user_id", "user_display_name", "user_screen_name", "account_creation_year",
        "account_language", "follower_count", "following_count",
    ]
    lost = F.filter(
        F.array(*[
            F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in required
        ]),
        lambda field: field.isNotNull(),
    )
    return users.select(F.explode(lost).alias("field")).groupBy("field").agg(
        F.count("*").alias("rows")
    )
