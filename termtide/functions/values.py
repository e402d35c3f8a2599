"""Field clean-up, month buckets, serving keys and display forms."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separates the entries of a packed list.
SEPARATOR = "\t,\t"
# Fixed value: shown in place of a hashed account name.
REDACTED = "<Redacted>"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def parse_list(value: Column) -> Column:
    """``[a, b]`` as an array; ``[]`` and blank are NULL."""
    items = F.split(F.regexp_replace(value, r"[\[\]]", ""), ", ")
    return F.when(~value.isin("[]", ""), items)


def month_bucket(time: Column, week_year: bool = False) -> Column:
    """``MM-yyyy``; with ``week_year`` the year is that of the week's Saturday, so the
    last days of December can fall in the next year."""
    day = F.to_date(time)
    if not week_year:
        return F.date_format(day, "MM-yyyy")
    saturday = F.date_add(day, 7 - F.dayofweek(day))
    return F.concat(F.date_format(day, "MM"), F.lit("-"), F.date_format(saturday, "yyyy"))


def serving_key(term: Column, month: Column) -> Column:
    return F.concat(term, F.lit("_"), month)


def key_term(key: Column) -> Column:
    """Everything before the month, so a term may itself contain ``_``."""
    return F.regexp_extract(key, r"(?s)^(.*)_(\d{2}-\d{4})$", 1)


def key_month(key: Column) -> Column:
    return F.regexp_extract(key, r"(?s)^(.*)_(\d{2}-\d{4})$", 2)


def month_start(month: Column) -> Column:
    return F.to_date(month, "MM-yyyy")


def is_hashed(display_name: Column, handle: Column) -> Column:
    return (F.length(display_name) == 64) & (F.length(handle) == 64)


def redact(name: Column, hashed: Column) -> Column:
    return F.when(hashed, F.lit(REDACTED)).otherwise(name)


def with_commas(number: Column) -> Column:
    return F.format_number(number, 0)
