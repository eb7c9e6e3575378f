import pytest

from tidemark.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


LONG = "lorem ipsum dolor sit amet " * 8000

#: Texts that have to work everywhere: null, empty, blank, marks, repeated, very long, odd characters.
TEXTS = [
    (1, "The cat sat on the mat and looked at the dog."),
    (2, "the CAT sat on the mat and looked at the dog."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "!!! 123 ..."),
    (7, LONG),
    (8, "La maison est à côté de l'église, n'est-ce pas ?"),
    (8, "La maison est à côté de l'église, n'est-ce pas ?"),
    (None, "a text without an id"),
    (9, "emoji 🙂 中文 and \u2581 marks  twice  spaced \x00 <|endoftext|> </s>"),
    (10, "The cat sat on the mat and looked at the dog"),
]


@pytest.fixture
def odd_docs(spark):
    """Texts with columns whose names the operators use themselves."""
    rows = [(i, t, "en", 1, "x", 2.0, 3) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp long, value string, score double, rank int")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture
def real_docs(spark):
    import os

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables are not here")
    return spark.read.parquet(path)
