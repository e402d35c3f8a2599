"""Table layouts. Column names and types are fixed by the data format."""

from pyspark.sql import types as T

# The 31 columns of the raw posts file, in file order.
RAW_POST_COLUMNS = [
    "tweetid", "userid", "user_display_name", "user_screen_name",
    "user_reported_location", "user_profile_description", "user_profile_url",
    "follower_count", "following_count", "account_creation_date",
    "account_language", "tweet_language", "tweet_text", "tweet_time",
    "tweet_client_name", "in_reply_to_tweetid", "in_reply_to_userid",
    "quoted_tweet_tweetid", "is_retweet", "retweet_userid", "retweet_tweetid",
    "latitude", "longitude", "quote_count", "reply_count", "like_count",
    "retweet_count", "hashtags", "urls", "user_mentions", "poll_choices",
]

# The 22 columns kept in the posts table, with their types.
POST_TYPES = {
    "tweetid": "string", "userid": "string", "tweet_language": "string",
    "tweet_text": "string", "tweet_time": "timestamp", "tweet_client_name": "string",
    "in_reply_to_tweetid": "string", "in_reply_to_userid": "string",
    "quoted_tweet_tweetid": "string", "is_retweet": "boolean",
    "retweet_userid": "string", "retweet_tweetid": "string",
    "latitude": "double", "longitude": "double",
    "quote_count": "int", "reply_count": "int", "like_count": "int",
    "retweet_count": "int", "hashtags": "array<string>", "urls": "array<string>",
    "user_mentions": "array<string>", "poll_choices": "array<string>",
}

# The 10 columns bound by header name from the accounts file.
RAW_USER_COLUMNS = [
    "userid", "user_display_name", "user_screen_name", "user_reported_location",
    "user_profile_description", "user_profile_url", "follower_count",
    "following_count", "account_creation_date", "account_language",
]

# Fields read from a stream message, of which the first three must be there.
MESSAGE_FIELDS = [
    "tweet_time", "tweet_text", "tweet_language", "userid", "hashtags",
    "quote_count", "reply_count", "like_count", "retweet_count",
]

NEEDED_FIELDS = MESSAGE_FIELDS[:3]

# The four per-post reaction counts, and the totals kept for them in every view.
COUNTS = ["quote_count", "reply_count", "like_count", "retweet_count"]
TOTALS = [f"total_{c}" for c in COUNTS]


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_POST_SCHEMA = all_strings(RAW_POST_COLUMNS)
