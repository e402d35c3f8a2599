"""Bursts in month series: a two-state automaton over the calendar months of each term."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import month_start

#: How many times the usual share a burst has, and what it costs to begin one.
RATIO, UP = 2.0, 1.0


def burst_states(view: DataFrame, term: str, ratio: float = RATIO, up: float = UP) -> DataFrame:
    """Per term: first_month, states (a digit for every calendar month of the view, 1 in a burst) and cost.

    Outside a burst a use of the month is this term's with the term's share of all uses of the view, in a burst with
    ``ratio`` times that, at most one half. The states are those of least cost: minus the log-likelihood of the term's
    and the month's uses, and ``up`` for each burst that begins; of equal ones those that stay. Months without the term, and without
    any use, are months too.

    A term's months are gathered as one map, of at most as many entries as the calendar has months, and
    folded in order; the months' totals are one row.
    """
    number = F.months_between(month_start(F.col("tweet_month")), F.lit("1970-01-01").cast("date")).cast("int")
    rows = view.select(F.col(term).alias("term"), number.alias("month"), "count")
    months = rows.groupBy("month").agg(F.sum("count").alias("n"))
    calendar = months.agg(
        F.min("month").alias("first"), F.max("month").alias("last"), F.sum("n").alias("all"),
        F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("totals"),
    )
    series = rows.groupBy("term").agg(
        F.sum("count").alias("uses"), F.map_from_entries(F.collect_list(F.struct("month", "count"))).alias("counts")
    )
    both = series.crossJoin(F.broadcast(calendar))  # one row
    usual = F.col("uses") / F.col("all")
    both = both.withColumns({"low": usual, "high": F.greatest(usual, F.least(usual * ratio, F.lit(0.5)))})
    folded = both.withColumn("fold", F.expr(f"""
        aggregate(
          transform(sequence(first, last), m -> struct(
            cast(coalesce(counts[m], 0) as double) as r, cast(coalesce(totals[m], 0) as double) as d)),
          named_struct('c0', 0D, 'c1', 1e300D, 'p0', '', 'p1', ''),
          (s, m) -> named_struct(
            'c0', least(s.c0, s.c1) - m.r * ln(low) - if(low < 1, (m.d - m.r) * ln(1 - low), 0D),
            'c1', least(s.c1, s.c0 + {float(up)}D) - m.r * ln(high) - if(high < 1, (m.d - m.r) * ln(1 - high), 0D),
            'p0', concat(if(s.c0 <= s.c1, s.p0, s.p1), '0'),
            'p1', concat(if(s.c1 <= s.c0 + {float(up)}D, s.p1, s.p0), '1')))"""))
    first = F.date_format(F.add_months(F.lit("1970-01-01").cast("date"), F.col("first")), "MM-yyyy")
    return folded.select(
        F.col("term").alias(term), first.alias("first_month"),
        F.expr("if(fold.c0 <= fold.c1, fold.p0, fold.p1)").alias("states"), F.least("fold.c0", "fold.c1").alias("cost"),
    )


def bursts(states: DataFrame, term: str) -> DataFrame:
    """A row per burst: term, its first month and how many months it lasts."""
    # Where a 1 follows a 0 or the start, and how long it goes on.
    places = F.expr("filter(sequence(1, length(states)), i -> substr(states, i, 1) = '1' and (i = 1 or substr(states, i - 1, 1) = '0'))")
    rows = states.select(term, "first_month", "states", F.explode(places).alias("at"))
    begins = F.add_months(month_start(F.col("first_month")), F.col("at") - 1)
    rest = F.expr("substr(states, at)")
    return rows.select(
        term, F.date_format(begins, "MM-yyyy").alias("from_month"),
        (F.length(rest) - F.length(F.ltrim(rest, F.lit("1")))).alias("months"),
    )
