import pytest


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns named like the operators' own."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    text = " ".join(f"alpha{i}" for i in range(120))
    near = text.replace("alpha60 ", "beta60 ")
    rows = [(1, text, "en"), (2, text, "en"), (3, near, "fr"), (3, near, "fr"), (4, None, None), (5, "", None), (6, "   \n ", "en"),
            (7, long, "en"), (None, "password=abcdefgh1 x", "fr"), (9, "12 34 !!", None), (10, "no\nno\nno\n", "fr")]
    df = spark.createDataFrame([(i, t, g, 0, 0, "x", 1, "k", 0.5, "r", "s") for i, t, g in rows],
                               "doc_id long, text string, lang string, slot int, bucket int, _n string, n_words int, secrets string, lang_score double, _rest string, next string")
    return df.cache()
