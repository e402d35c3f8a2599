"""Line deduplication and source mixing."""

import hashlib
from collections import defaultdict

import check
import pytest

from termtide.llm import line_dedup, mixing, near_dup, quality, queries

LINE = "This line is long enough to count."


def test_lines(docs):
    rows = docs(
        (1, f"a\n{LINE}\nb"), (2, f"\x0b {LINE.upper()}\t\r\n{LINE}"), (3, f"{LINE}\n{LINE}"), (4, None), (5, ""),
        (None, f"{LINE}\nz"), (6, "short\nshort"), (7, "short"), (8, "short"), (1, f"a\n{LINE}\nb"),
    )
    found = line_dedup.dedup_lines(rows)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "n_lines", "n_dropped"]
    got = sorted((r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in found.collect())
    assert got == [
        (0, "z", 2, 1), (1, "a\nb", 3, 1), (1, "a\nb", 3, 1), (2, "", 2, 2), (3, f"{LINE}\n{LINE}", 2, 0),
        (4, "", 1, 0), (5, "", 1, 0), (6, "short\nshort", 2, 0), (7, "short", 1, 0), (8, "short", 1, 0),
    ]


def test_two_documents_are_not_enough_and_case_is_ascii(docs):
    rows = docs((1, LINE), (2, LINE), (3, "É" + LINE), (4, "é" + LINE), (5, "É" + LINE))
    assert [r.n_dropped for r in line_dedup.dedup_lines(rows).collect()] == [0] * 5


def test_long_text_keeps_its_order(docs):
    text = "\n".join(f"line number {i} of a very long text" for i in range(3000))
    other = "\n".join(f"line number {i} of a very long text" for i in range(0, 3000, 2))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs((1, text), (2, other), (3, other))).collect()}
    assert got[1].split("\n") == text.split("\n")[1::2] and got[2] == "" and got[3] == other


def test_stage_keeps_columns(docs):
    rows = docs((1, f"{LINE}\na"), (2, LINE), (3, LINE))
    found = line_dedup.drop_shared_lines(rows)
    assert found.columns == rows.columns
    assert sorted((r.doc_id, r.n_chars) for r in found.collect()) == [(1, 1), (2, 0), (3, len(LINE))]


def test_mix(docs):
    rows = docs(
        *((i, "w " * 10, "a") for i in range(300)), *((1000 + i, "w " * 10, "b") for i in range(30)),
        *((2000 + i, "w " * 5, None) for i in range(200)), (5000, None, "b"), (5001, "", "c"), (None, "w", "a"),
        (7, "w " * 10, "a"),
    )
    got = mixing.mix_sizes(rows).collect()
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert size == {"a": 3011, "b": 300, "c": 0, None: 1000}
    # b would get 4311 * 2 / 7 and stops at 900; c has nothing; a and null share the rest 1 to 1.
    assert target["b"] == 900 and target["c"] == 0
    assert target["a"] == pytest.approx(3411 / 2) and target[None] == pytest.approx(3411 / 2)
    assert all(abs(taken[s] - target[s]) <= 10 for s in size)
    again = mixing.mix_sizes(rows.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    copies = defaultdict(int)
    for r in mixing.mix(rows).collect():
        copies[r.source] += len((r.text or "").split())
    assert copies == {s: n for s, n in taken.items() if n}


def test_larger_budget_holds_the_smaller(docs):
    rows = docs(*((i, "w " * (i % 7 + 1), "a") for i in range(400)), *((i, "w " * 9, "b") for i in range(500, 700)))
    less = {r.doc for r in mixing.mix_sizes(rows, weights=(1, 2)).collect() if r.source == "a" and r.copies}
    more = {r.doc for r in mixing.mix_sizes(rows, weights=(1, 1)).collect() if r.source == "a" and r.copies}
    assert less < more


#: Names that the operators use themselves, in some case.
TAKEN = "doc version of places upto whole copies copy at key keeper Doc_ __version __of __upto __copy __copies __text n component".split()


def test_any_names_of_other_columns(spark):
    text = "\n".join(["one two three four five six", LINE])
    rows = [
        (i, f"{text}\n{i % 2} tail" if i else None, "a" if i % 2 else None, "s", *[f"{n}{i}" for n in TAKEN]) for i in range(6)
    ]
    columns = ", ".join(f"`{n}` string" for n in TAKEN)
    table = spark.createDataFrame(rows, f"doc_id bigint, text string, source string, lang string, {columns}")

    def untouched(found):
        assert found.columns[: len(table.columns)] == table.columns
        got = found.collect()
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in TAKEN)
        return got

    assert untouched(mixing.mix(table))
    lines = untouched(line_dedup.dedup_lines(table))
    assert sorted((r.doc_id, r.n_dropped) for r in lines) == [(i, 2 if 0 < i < 5 else 0) for i in range(6)]
    untouched(line_dedup.drop_shared_lines(table))
    assert untouched(near_dup.keep_one(table))
    untouched(quality.keep_good(table))


def test_empty(docs):
    assert line_dedup.dedup_lines(docs()).count() == mixing.mix_sizes(docs()).count() == mixing.mix(docs()).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, small, name):
    assert check.compare(spark, check.oracle(small), name, small) == ""


def test_digest(docs):
    r = line_dedup.dedup_lines(docs((1, "é\n"))).selectExpr("sha2(text, 256) as s").first()
    assert r.s == hashlib.sha256("é\n".encode()).hexdigest()
