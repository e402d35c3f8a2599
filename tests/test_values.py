from datetime import datetime

from pyspark.sql import functions as F

from termtide.functions import accounts, values as v



def column(rows, values, expression, schema="v string"):
    return [r[0] for r in rows(values, expression, schema=schema)]


def test_blank_and_lists(rows):
    assert column(rows, ["", " ", "a", None], v.blank_to_null(F.col("v"))) == [None, " ", "a", None]
    got = column(rows, ["[a, b]", "[]", "", "[x]", None], v.parse_list(F.col("v")))
    assert got == [["a", "b"], None, None, ["x"], None]


def test_month_and_week_year(rows):
    days = [datetime(2015, 12, 31, 23), datetime(2015, 12, 26), datetime(2016, 1, 1), datetime(2016, 12, 31)]
    assert column(rows, days, v.month_bucket(F.col("v")), "v timestamp") == ["12-2015", "12-2015", "01-2016", "12-2016"]
    weekly = column(rows, days, v.month_bucket(F.col("v"), week_year=True), "v timestamp")
    assert weekly == ["12-2016", "12-2015", "01-2016", "12-2016"]


def test_key_of_a_term_with_underscore(rows):
    got = rows(["a_b_01-2017"], v.key_term(F.col("v")), v.key_month(F.col("v")))[0]
    assert list(got) == ["a_b", "01-2017"]


def test_redaction_needs_both_hashed(spark):
    hashed, plain = "f" * 64, "name"
    df = spark.createDataFrame([(hashed, hashed), (hashed, plain), (plain, hashed)], "n string, h string")
    both = v.is_hashed(F.col("n"), F.col("h"))
    got = [tuple(r) for r in df.select(v.redact(F.col("n"), both), v.redact(F.col("h"), both)).collect()]
    assert got == [("<Redacted>", "<Redacted>"), (hashed, plain), (plain, hashed)]


def test_commas(rows):
    assert column(rows, [1234567, 12], v.with_commas(F.col("v")), "v bigint") == ["1,234,567", "12"]


def test_languages(rows):
    assert len(accounts.LANGUAGES) == 47
    assert column(rows, ["en-gb", "xx", None], accounts.language_name(F.col("v"))) == ["BRITISH_ENGLISH", None, None]


def test_dates(rows):
    got = column(rows, ["2015-02-03", "03.02.2015", ""], accounts.created_on(F.col("v")))
    assert [str(d) for d in got] == ["2015-02-03", "None", "None"]
