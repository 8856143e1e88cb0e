import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from ``[(doc_id, text, source, lang)]``; extra columns carry names the operators use inside."""

    def make(rows, extra=False):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, source, lang in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("fp", "key", "size", "score", "bucket", "mask", "words", "slot", "component", "_id", "doc", "n", "text_key", "epochs", "taken", "_leak", "times", "copy", "held_out", "lang_pred"):
                df = df.withColumn(name, F.lit(name))
        return df

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and wordless texts, a very long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(60_000))
    return [
        (0, None, "a", "en"),
        (1, "", None, None),
        (2, " \t\n ", "a", "en"),
        (3, "one two", "b", "en"),
        (4, long, "b", "en"),
        (5, "the same text of several words here", "c", "en"),
        (6, "the same text of several words here", "c", "fr"),
        (6, "the same text of several words here", "c", "fr"),
        (None, "a text without any id at all", "c", "en"),
        (8, "12 34 !!", "a", "en"),
        (9, "über straße naïve ÉTÉ ∑ \U0001f600", "a", "de"),
    ]
