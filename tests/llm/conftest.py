import pytest

SF = "/root/testdata/sf0.001"

#: Null, empty, blank, tie and repeat cases, beside columns whose names operators might use themselves.
EDGE = [
    (1, "alpha beta gamma delta", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \t\n ", "fr"),
    (5, "alpha beta gamma delta", "en"),
    (5, "alpha beta gamma delta", "en"),
    (None, "no id here at all", "en"),
    (7, "word " * 60_000, "en"),
    (8, "x", "de"),
    (9, "É ñ ß 漢字 🙂 \x1c end.", "xx"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, lang, "src", 0, "clash", 1, 2, "k") for i, t, lang in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words string, fp int, start int, __kept string").repartition(3)


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


@pytest.fixture(scope="session")
def shared_ids(spark):
    """Rows that share ids: a copy, an equal row, one with a text of its own, and one that ends like another document."""
    import random

    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    a, b, c = words(60), words(60), words(40)
    rows = [(1, a), (2, a), (2, a), (2, b), (3, c + "\n" + b), (3, c), (4, None), (4, ""), (4, words(50)), (None, a), (None, words(9))]
    return a, b, c, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
