import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import check  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    yield check.session()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def rows(spark):
    """Rows of one expression per column, evaluated over a list of inputs."""
    def evaluate(values, *columns, schema="v string"):
        return spark.createDataFrame([(v,) for v in values], schema).select(*columns).collect()

    return evaluate


@pytest.fixture
def post(spark):
    """A posts table from dictionaries; what is left out has a plain value."""
    schema = (
        "tweetid string, userid string, tweet_language string, tweet_text string, "
        "tweet_time timestamp, quote_count int, reply_count int, like_count int, "
        "retweet_count int, hashtags array<string>"
    )
    from datetime import datetime

    plain = {
        "tweetid": "1", "userid": "u1", "tweet_language": "en", "tweet_text": "red fox runs",
        "tweet_time": datetime(2017, 3, 5, 12), "quote_count": 1, "reply_count": 2,
        "like_count": 3, "retweet_count": 4, "hashtags": None,
    }

    def table(*given):
        return spark.createDataFrame([tuple({**plain, **g}.values()) for g in given], schema)

    return table
