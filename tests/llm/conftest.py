import pytest

#: Columns that operators also use inside.
EXTRA = "score double, fp string, token string, pos int, length int, part int, key string, root int, piece int, y int, sign int, _text_key string, _doc_key string, row string, id string"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
LONG = "river " * 3_000 + "a" * 20_000 + " " + "stone bridge over the water " * 500


def rows(*pairs):
    return [(i, t, "en", "s", len(t or ""), *[None] * 15) for i, t in pairs]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, a very long one, copies, a repeated row, a null id, clashing column names."""
    pairs = [
        (1, None), (2, ""), (3, LONG), (4, "the same words in two rows"), (5, "the same words in two rows"),
        (5, "the same words in two rows"), (None, "no id at all"), (6, " \n\t "), (7, "é É   ß 漢字 😀"), (8, "x" * 50_000),
    ]
    return spark.createDataFrame(rows(*pairs), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
