import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (doc_id, text[, lang[, source]]) rows, with extra columns of clashing names."""

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        return df.selectExpr("*", "1 AS n", "'x' AS key", "2 AS size", "3 AS component_id", "4 AS start", "5 AS rep", "6 AS bucket", "7 AS taken") if extra else df

    return make


@pytest.fixture(scope="session")
def nasty(docs):
    """Nulls, empty and long texts, repeated rows and ties."""
    long_text = " ".join(f"word{i % 977} tail{i % 31}" for i in range(12_000))
    return docs([(None, "no id here at all", None, None), (1, None, None, "a"), (2, "", "en", None), (3, "   \n\t ", "en", "a"), (4, "short", None, "b"), (5, long_text, "en", "a"), (6, long_text, "en", "a"), (6, long_text, "en", "a"), (7, "x" * 30_000, None, "b"), (8, "tab\tand  two spaces \n\n end ", "de", "b"), (9, "été 123 <|endoftext|>!? 'twas don't", "fr", "c"), (9, "same id other text", "fr", "c")])
