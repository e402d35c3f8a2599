"""Posts and accounts made from the given tables.

Every statement is written once, with table names as parameters, and runs unchanged in
Spark SQL and in the oracle's SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.accounts import LANGUAGES
from ..functions.values import parse_list
from ..session import spread
from ..sources.posts import normalize_posts

TABLES = ["documents", "orders", "customer", "nation", "benchmark"]

# Accounts as they were appended over time: three versions each, none before 1995-03.
ACCOUNT_VERSIONS = """
select cast(c.c_custkey as string) as user_id,
  timestamp '1995-03-01 00:00:00' + interval '1' day * (v.n * 700 + c.c_custkey % 300) as valid_from,
  concat(c.c_name, '/', cast(v.n as string)) as user_display_name,
  case when (c.c_custkey + v.n) % 4 = 0 then null
       else concat(c.c_mktsegment, cast(v.n as string)) end as user_profile_description
from {customer} c join (values (0), (1), (2)) as v(n) on c.c_custkey > v.n - 1
"""

# Every account language code and one that is not listed, by number.
CODES = ", ".join(f"({i}, '{code}')" for i, code in enumerate([*LANGUAGES, "xx"]))

_TEXT = """case when d.doc_id % 5 = 0
       then concat('RT @', d.source, ': ', d.text, ' #', d.source,
                   ' https://ex.org/a?b=', cast(d.doc_id as string))
       else d.text end"""

# Posts with typed columns; the hashtag list is still text.
POSTS = f"""
select cast(d.doc_id as string) as tweetid,
  cast(o.o_custkey as string) as userid,
  d.lang as tweet_language,
  {_TEXT} as tweet_text,
  o.o_orderdate as tweet_time,
  d.source as tweet_client_name,
  case when d.doc_id % 11 = 0 then null
       else cast(floor(o.o_totalprice) as bigint) % 13 end as quote_count,
  cast(floor(o.o_totalprice) as bigint) % 17 as reply_count,
  cast(floor(o.o_totalprice) as bigint) % 101 as like_count,
  cast(floor(o.o_totalprice) as bigint) % 41 as retweet_count,
  case when d.doc_id % 3 = 0 then null
       else concat('[', d.source, ', ', o.o_orderpriority, ']') end as hashtags
from {{documents}} d join {{orders}} o on o.o_orderkey = d.doc_id
"""

# A later snapshot of the same posts: some gone, some with another text, some with other counts.
EDITED_POSTS = f"""
select tweetid, userid, tweet_language,
  case when cast(tweetid as bigint) % 5 = 1 then concat(tweet_text, ' corrected by its author later')
       else tweet_text end as tweet_text,
  tweet_time, tweet_client_name,
  case when cast(tweetid as bigint) % 4 = 2 then null else quote_count end as quote_count,
  reply_count,
  like_count + case when cast(tweetid as bigint) % 9 = 4 then 7 else 0 end as like_count,
  retweet_count, hashtags
from ({POSTS.strip()}) p where cast(tweetid as bigint) % 7 <> 0
"""

USERS = """
select cast(c.c_custkey as string) as user_id, c.c_name as user_display_name,
  lower(c.c_name) as user_screen_name,
  case when c.c_custkey % 7 = 0 then null else n.n_name end as user_reported_location,
  c.c_mktsegment as user_profile_description
from {customer} c join {nation} n on n.n_nationkey = c.c_nationkey
"""

# Account columns as the text of a CSV file, in another order than the table's.
_ACCOUNT = """
  c.c_name as user_display_name,
  lower(c.c_name) as user_screen_name,
  case when c.c_custkey % 7 = 0 then '' else n.n_name end as user_reported_location,
  c.c_mktsegment as user_profile_description,
  case when c.c_custkey % 5 = 0 then ''
       else concat('https://ex.org/u/', cast(c.c_custkey as string)) end as user_profile_url,
  cast(c.c_custkey * 7 % 5000 as string) as follower_count,
  case when c.c_custkey % 9 = 0 then '' else cast(c.c_custkey * 3 % 900 as string) end
    as following_count,
  case when c.c_custkey % 19 = 0 then 'unknown'
       else concat(cast(2006 + c.c_custkey % 13 as string), '-',
                   lpad(cast(1 + c.c_custkey % 12 as string), 2, '0'), '-',
                   lpad(cast(1 + c.c_custkey % 28 as string), 2, '0')) end
    as account_creation_date,
  l.code as account_language"""

_ACCOUNT_JOINS = f"""
  join {{nation}} n on n.n_nationkey = c.c_nationkey
  join (values {CODES}) as l(k, code) on l.k = c.c_custkey % {len(LANGUAGES) + 1}"""

RAW_USERS = f"""
select {_ACCOUNT.strip()},
  cast(c.c_custkey as string) as userid
from {{customer}} c {_ACCOUNT_JOINS}
"""

# The 31 columns of the raw file as text: blanks, empty lists and values that do not cast.
RAW_POSTS = f"""
select cast(d.doc_id as string) as tweetid,
  cast(o.o_custkey as string) as userid, {_ACCOUNT},
  d.lang as tweet_language,
  case when d.doc_id % 37 = 0 then '' else {_TEXT} end as tweet_text,
  case when d.doc_id % 41 = 0 then '' else cast(o.o_orderdate as string) end as tweet_time,
  d.source as tweet_client_name,
  case when d.doc_id % 4 = 0 then cast(d.doc_id + 1 as string) else '' end as in_reply_to_tweetid,
  case when d.doc_id % 4 = 0 then cast(o.o_custkey + 1 as string) else '' end
    as in_reply_to_userid,
  case when d.doc_id % 6 = 0 then cast(d.doc_id + 2 as string) else '' end
    as quoted_tweet_tweetid,
  case when d.doc_id % 5 = 0 then 'true' else 'false' end as is_retweet,
  case when d.doc_id % 5 = 0 then cast(o.o_custkey + 2 as string) else '' end as retweet_userid,
  case when d.doc_id % 5 = 0 then cast(d.doc_id + 3 as string) else '' end as retweet_tweetid,
  case when d.doc_id % 8 = 0 then cast(d.doc_id % 90 + 0.5 as string) else '' end as latitude,
  case when d.doc_id % 8 = 0 then cast(d.doc_id % 180 + 0.25 as string) else '' end as longitude,
  case when d.doc_id % 11 = 0 then ''
       else cast(cast(floor(o.o_totalprice) as bigint) % 13 as string) end as quote_count,
  cast(cast(floor(o.o_totalprice) as bigint) % 17 as string) as reply_count,
  case when d.doc_id % 23 = 0 then 'n/a'
       else cast(cast(floor(o.o_totalprice) as bigint) % 101 as string) end as like_count,
  cast(cast(floor(o.o_totalprice) as bigint) % 41 as string) as retweet_count,
  case when d.doc_id % 3 = 0 then '[]'
       else concat('[', d.source, ', ', o.o_orderpriority, ']') end as hashtags,
  case when d.doc_id % 5 = 0 then concat('[https://ex.org/a?b=', cast(d.doc_id as string), ']')
       else '' end as urls,
  case when d.doc_id % 5 = 0 then concat('[', cast(o.o_custkey + 2 as string), ']')
       else '[]' end as user_mentions,
  '' as poll_choices
from {{documents}} d join {{orders}} o on o.o_orderkey = d.doc_id
  join {{customer}} c on c.c_custkey = o.o_custkey {_ACCOUNT_JOINS}
"""

# Accounts of which some have a name, a handle or both of the length of a hash.
HASHED_USERS = """
select cast(c.c_custkey as string) as user_id,
  case when c.c_custkey % 3 = 0 or c.c_custkey % 5 = 0 then rpad(c.c_name, 64, '0')
       else c.c_name end as user_display_name,
  case when c.c_custkey % 3 = 0 then rpad(lower(c.c_name), 64, '0')
       else lower(c.c_name) end as user_screen_name
from {customer} c
"""


def for_oracle(statement: str) -> str:
    return statement.format(**{t: t for t in TABLES}).strip()


def _run(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    used = [t for t in TABLES if f"{{{t}}}" in statement]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    if "documents" in tables:
        tables["documents"] = spread(tables["documents"], "doc_id")
    return spark.sql(statement, **tables)


def listed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed posts whose hashtag list is still text."""
    return _run(spark, sf_dir, POSTS)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed_posts(spark, sf_dir).withColumn("hashtags", parse_list(F.col("hashtags")))


def edited_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, EDITED_POSTS).withColumn("hashtags", parse_list(F.col("hashtags")))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_POSTS)


def clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_posts(raw_posts(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, USERS)


def account_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ACCOUNT_VERSIONS)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_USERS)


def hashed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, HASHED_USERS)
