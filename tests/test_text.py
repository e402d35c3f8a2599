from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from termtide.functions import text as tx
from termtide.operators.terms import explode_ngrams, with_words


def words(spark, text, **params):
    return with_words(spark.createDataFrame([(text,)], "tweet_text string"), **params).first()[0]


def test_stop_words_are_the_default_list(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == tx.STOP_WORDS


def test_noise_is_removed(rows):
    text = "RT @someone: see https://a.b/c?d=e now @you #Tag1 ok"
    assert rows([text], tx.clean_text(F.col("v")))[0][0] == "see  now   ok"


def test_single_patterns(rows):
    text = "rt @x: a http://b.c @d #e"
    got = rows([text], *[tx.clean_text(F.col("v"), p) for p in (tx.URL, tx.RETWEET, tx.HANDLE, tx.HASHTAG)])
    assert list(got[0]) == ["rt @x: a  @d #e", "a http://b.c @d #e", "rt  a http://b.c  #e", "rt @x: a http://b.c @d "]


def test_apostrophes_split_before_stop_words(spark):
    assert words(spark, "Don't stop me") == ["stop"]


def test_underscore_joins_and_accents_split(spark):
    assert words(spark, "snake_case café été1") == ["snake_case", "caf", "1"]


def test_null_text(spark):
    assert words(spark, None) is None


def test_own_stop_words_with_quotes_and_backslashes(spark):
    assert words(spark, "a fox it's", stop_words=["it's", "\\w", "fox"]) == ["a", "it", "s"]


def ngrams(spark, text, sizes):
    posts = with_words(spark.createDataFrame([(text,)], "tweet_text string"))
    return [r[0] for r in explode_ngrams(posts, sizes).collect()]


def test_ngrams_span_removed_words(spark):
    assert ngrams(spark, "word of mouth spreads", [2]) == ["word mouth", "mouth spreads"]


def test_too_few_words(spark):
    assert ngrams(spark, "red fox", [3]) == []
    assert ngrams(spark, "fox", [2, 3, 4, 5]) == []
    assert ngrams(spark, None, [2]) == []


def test_sizes_may_leave_gaps(spark):
    assert ngrams(spark, "aa bb cc dd", [2, 4]) == ["aa bb", "bb cc", "cc dd", "aa bb cc dd"]
    assert ngrams(spark, "aa bb", [1]) == ["aa", "bb"]


def test_same_as_ml_transformers(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    cleaned = docs.select("doc_id", tx.clean_text(F.col("text")).alias("clean"))
    tokens = RegexTokenizer(inputCol="clean", outputCol="raw", pattern=r"[\W-']").transform(cleaned)
    kept = StopWordsRemover(
        inputCol="raw", outputCol="words", stopWords=StopWordsRemover.loadDefaultStopWords("english")
    ).transform(tokens)
    ours = with_words(docs.withColumnRenamed("text", "tweet_text"))
    for n in (2, 3, 4, 5):
        theirs = NGram(n=n, inputCol="words", outputCol="grams").transform(kept)
        theirs = theirs.select("doc_id", F.explode("grams").alias("ngram"))
        mine = explode_ngrams(ours, [n])
        assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()
