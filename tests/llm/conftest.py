import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string, kept string"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source) rows, with columns that clash with results."""
    def table(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "x", "y") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return table


@pytest.fixture
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut".split()


@pytest.fixture
def prose():
    """So many words, different for each seed."""
    import random

    def words(n, seed=0):
        pick = random.Random(seed)
        return [pick.choice(WORDS) + str(pick.randrange(500)) for _ in range(n)]

    return words
