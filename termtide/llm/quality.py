"""Rules for text quality: fixed ones, and robust outliers among text statistics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.tables import give_back, hinted, written
from termtide.session import join_hint
from termtide.llm.textscan import (
    BLANK, counts_in, lines_of, mixed, pieces, runs_of, texts_of, words_of,
)

#: Name and least spread of each statistic. The spread, as a standard deviation, keeps a statistic
#: that is the same in nearly all texts of a group from rejecting the few where it differs a bit.
STATISTICS = {
    "word_length": 0.15, "symbols": 0.2, "upper": 0.12, "marks": 0.15, "no_letter": 0.12,
    "digits": 0.25, "same_lines": 0.25, "repeats": 0.2, "variety": 0.06,
}
P = len(STATISTICS)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
)
PIECE = 1 << 20
_SYMBOL, _MARK, _UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK[list(b"!\"'()+,-./:;=?@[\\]^_`{}~")] = True
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)


def repeated(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, value) pairs: is there another one; is it one of them, but not the one that counts.

    Pairs are told apart by a 64-bit hash of both, as their values are hashes already.
    """
    key = mixed(value + mixed(row.astype(np.uint64)))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    later = np.concatenate(([False], same)) if len(order) else np.zeros(0, bool)
    any_ = later.copy()
    any_[:-1] |= same
    out = np.zeros((2, len(order)), bool)
    out[0, order], out[1, order] = any_, later
    return out[0], out[1]


def text_counts(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and its transformed statistics as rows of a matrix."""
    texts = texts_of(column)
    data, a, b, n = texts.data, texts.offset[:-1], texts.offset[1:], len(texts)
    words = words_of(texts)
    count = lambda mask: counts_in(mask[data], a, b)
    by_row = lambda rows: np.bincount(rows, minlength=n)
    n_words = by_row(words.row)
    chars = counts_in(~BLANK[data] & ((data & 0xC0) != 0x80), a, b)
    value, row, first, end = lines_of(texts)
    spoken = counts_in(~BLANK[data], first, end) > 0
    value, row = value[spoken], row[spoken]
    _, earlier = repeated(row, value)
    same_lines = by_row(row[earlier])
    value, start = runs_of(words.hash, words.row, 8)
    again, _ = repeated(words.row[start], value)
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, start[again], 1)
    np.add.at(cover, start[again] + 8, -1)
    repeats = by_row(words.row[np.cumsum(cover[:-1]) > 0])
    _, known = repeated(words.row, words.hash)
    different = n_words - by_row(words.row[known])
    bare = by_row(words.row[counts_in(_LETTER[data], words.first, words.end) == 0])
    counts = dict(zip(COUNTS, (n_words, chars, count(_SYMBOL), same_lines, repeats)))
    some = np.maximum(n_words, 1)
    matrix = np.stack(
        [
            np.log(np.maximum(chars, 1) / some), np.sqrt(counts["n_symbols"] / some),
            np.sqrt(count(_UPPER) / np.maximum(count(_ASCII_LETTER), 1)), np.sqrt(count(_MARK) / some),
            np.sqrt(bare / some), np.sqrt(np.minimum(count(_DIGIT) / some, 4)),
            np.sqrt(same_lines / np.maximum(by_row(row), 1)), np.sqrt(repeats / some),
            np.log(np.maximum(different, 1)) / np.log(some + 1),
        ],
        axis=1,
    )
    return counts, matrix


def statistics_of(docs: DataFrame, id_col: str, text_col: str, keys: tuple[str, ...]) -> DataFrame:
    """doc, the key columns, the counts and the statistics of every row."""
    kinds = docs.select(F.col(id_col).alias("doc"), *(F.col(k) for k in keys))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.schema]
    fields += [f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in STATISTICS]
    names, width = [*kinds.columns, *COUNTS, *STATISTICS], len(kinds.columns)

    def scanned(batches):
        for batch in batches:
            for piece in pieces(batch, "__text", PIECE):
                counts, matrix = text_counts(piece.column("__text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(i) for i in range(width)),
                        *(pa.array(counts[c]) for c in COUNTS),
                        *(pa.array(np.ascontiguousarray(column)) for column in matrix.T),
                    ],
                    names,
                )
        give_back()

    return docs.select(
        F.col(id_col).alias("doc"), *(F.col(k) for k in keys), F.col(text_col).alias("__text")
    ).mapInArrow(scanned, ", ".join(fields))


def chi_square(share: float, degrees: int) -> float:
    """The quantile, by Wilson and Hilferty's approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(share)
    return degrees * (1 - 2 / (9 * degrees) + z * math.sqrt(2 / (9 * degrees))) ** 3


CENTRE = [f"m{i}" for i in range(P)]
SHAPE = [f"l{i}_{j}" for i in range(P) for j in range(i + 1)]


def distance() -> Column:
    """Squared Mahalanobis distance: statistics less centre, times the inverse Cholesky factor."""
    total = F.lit(0.0)
    gap = [F.col(x) - F.col(m) for x, m in zip(STATISTICS, CENTRE)]
    for i in range(P):
        along = F.lit(0.0)
        for j in range(i + 1):
            along = along + F.col(f"l{i}_{j}") * gap[j]
        total = total + along * along
    return total


def shapes_of(moments: DataFrame) -> DataFrame:
    """Per cell: centre and inverse Cholesky factor of the covariance, from sums of products."""
    floor = np.diag(np.square(list(STATISTICS.values())))

    def solved(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                mean = np.array([r[f"s{i}"] for i in range(P)]) / r["n"]
                cov = np.zeros((P, P))
                for i in range(P):
                    for j in range(i + 1):
                        cov[i, j] = cov[j, i] = r[f"s{i}_{j}"] / r["n"] - mean[i] * mean[j]
                inverse = np.linalg.inv(np.linalg.cholesky(cov + floor))
                out.append([r["cell"], *mean, *(inverse[i, j] for i in range(P) for j in range(i + 1))])
            columns = list(zip(*out)) if out else [()] * (1 + len(CENTRE) + len(SHAPE))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *(pa.array(c, pa.float64()) for c in columns[1:])],
                ["cell", *CENTRE, *SHAPE],
            )

    fields = ", ".join(f"{c} double" for c in CENTRE + SHAPE)
    return moments.mapInArrow(solved, f"cell string, {fields}")


def moments_of(rows: DataFrame) -> DataFrame:
    names = list(STATISTICS)
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(names)]
    sums += [
        F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i in range(P) for j in range(i + 1)
    ]
    return rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sums)


def octave(value: Column) -> Column:
    """A fine bucket of a squared distance, 64 to each doubling."""
    return F.floor(F.log2(F.greatest(value, F.lit(1e-6))) * 64).cast("int")


def limits_of(rows: DataFrame, share: float) -> DataFrame:
    """Per cell the bucket below or in which that share of the distances lies."""
    from pyspark.sql import Window

    held = rows.groupBy("cell", octave(F.col("d2")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("cell").orderBy("bucket")
    total = F.sum("n").over(Window.partitionBy("cell"))
    return (
        held.withColumn("upto", F.sum("n").over(order)).withColumn("total", total)
        .where(F.col("upto") >= share * F.col("total"))
        .groupBy("cell").agg(F.min("bucket").alias("edge"))
    )


def cell_hint(cells: DataFrame) -> str:
    """How a table of one row per cell is joined: by the measured names of the cells, and room for
    as many numbers as any such table has."""
    return join_hint(cells.select("cell", F.lit("-" * 24 * (len(CENTRE) + len(SHAPE) + 1)).alias("numbers")))


def robust_shapes(rows: DataFrame, share: float, steps: int, hint: str) -> DataFrame:
    """Minimum-covariance-determinant estimates per cell, by concentration steps.

    From medians and the spread about them, each step keeps the ``share`` of rows nearest to the
    centre and estimates again from their sums of products. Nothing but sums and histograms by cell
    is shuffled, so a cell of any size has a map side. The covariance is then scaled up if the
    median distance is over that of the normal distribution.
    """
    names = list(STATISTICS)
    middle = rows.groupBy("cell").agg(
        *(F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(names))
    )
    middle = written(middle, "quality-medians")
    spread = rows.join(middle.hint(hint), "cell").groupBy("cell").agg(
        *(
            F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10000).alias(f"d{i}")
            for i, x in enumerate(names)
        )
    )
    start = middle.join(spread, "cell")
    scale = [
        F.sqrt(F.pow(1.4826 * F.col(f"d{i}"), 2) + F.lit(floor**2))
        for i, floor in enumerate(STATISTICS.values())
    ]
    shapes = start.select(
        "cell", *CENTRE,
        *(
            (1 / scale[i] if i == j else F.lit(0.0)).alias(f"l{i}_{j}")
            for i in range(P) for j in range(i + 1)
        ),
    )
    for _ in range(steps):
        placed = rows.join(written(shapes, "quality-shapes").hint(hint), "cell").withColumn("d2", distance())
        limits = written(limits_of(placed, share), "quality-limits")
        near = placed.join(limits.hint(hint), "cell").where(octave(F.col("d2")) <= F.col("edge"))
        shapes = shapes_of(moments_of(near))
    shapes = written(shapes, "quality-shapes")
    placed = rows.join(shapes.hint(hint), "cell").withColumn("d2", distance())
    middle = limits_of(placed, 0.5).select(
        "cell",
        F.greatest(
            F.pow(F.lit(2.0), (F.col("edge") + 1) / 64.0) / chi_square(0.5, P), F.lit(1.0)
        ).alias("scale"),
    )
    return written(shapes.join(middle, "cell"), "quality-robust")


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    keys: tuple[str, str] = ("lang", "source"), least_rows: int = 100, share: float = 0.75,
    steps: int = 3, trust: float = 0.9998,
) -> DataFrame:
    """Per row: doc, counts, base_failed, kept, d2 (scaled squared distance; null: no estimate).

    base_failed: under 20 words, or over 30 % of the words in repeated 8-word windows. Other rows
    are kept unless their d2 is over the ``trust`` quantile of chi-square.

    A cell is a language and source with ``least_rows`` rows that pass the base rules; rows of
    smaller ones share a cell by language, and what is too small there shares one more. Rows of a
    cell still too small have no estimate and are kept. A null language or source is one like any
    other, a null text has no words. Rows are judged one by one: repeated rows get the same result,
    a null id stays null. An empty table gives no rows. Other columns are not read.
    """
    lang, source = keys
    rows = written(statistics_of(docs, id_col, text_col, keys), "quality-statistics")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    fine = rows.where("not base_failed")
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    by_both = F.concat_ws("\x1f", tag(lang), tag(source))
    by_lang = F.concat(F.lit("lang\x1f"), tag(lang))
    sizes = written(fine.groupBy(lang, source).agg(F.count(F.lit(1)).alias("n")), "quality-sizes")
    small = sizes.where(F.col("n") < least_rows).groupBy(lang).agg(F.sum("n").alias("rest"))
    cell = F.when(F.col("n") >= least_rows, by_both).when(F.col("rest") >= least_rows, by_lang)
    cells = sizes.alias("s").join(
        small.select(F.col(lang).alias("__lang"), "rest"), F.col(lang).eqNullSafe(F.col("__lang")), "left"
    ).select(
        F.col(lang).alias("__lang"), F.col(source).alias("__source"),
        F.coalesce(cell, F.lit("others")).alias("cell"), "n",
    )
    cells = written(cells, "quality-cells")
    placed = rows.join(
        hinted(cells.drop("n")),
        F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left",
    ).drop("__lang", "__source")
    fit = placed.where("not base_failed").select("cell", *STATISTICS)
    enough = cells.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least_rows).select("cell")
    hint = cell_hint(enough)
    fit = fit.join(enough.hint(hint), "cell")
    shapes = robust_shapes(fit, share, steps, hint)
    measured = placed.join(shapes.hint(hint), "cell", "left").withColumn("d2", distance() / F.col("scale"))
    far = F.coalesce(F.col("d2") > chi_square(trust, P), F.lit(False))
    return measured.select(
        "doc", *COUNTS, "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "d2", *STATISTICS
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that `judge_quality` keeps, with their columns.

    Rows of one id are judged together: they stay if one of them is kept. Rows with a null id stay.
    """
    verdicts = judge_quality(docs, id_col, **options).select("doc", "kept")
    gone = verdicts.groupBy("doc").agg(F.max("kept").alias("kept")).where("not kept").select("doc")
    gone = written(gone, "quality-gone")
    return docs.join(hinted(gone), docs[f"`{id_col}`"] == gone["doc"], "left_anti")
