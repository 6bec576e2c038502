import pytest


LONG = "alpha beta gamma delta " * 3000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties and clashing extra columns."""
    rows = [
        (1, "One two three four five six.\nSeven eight nine ten eleven twelve.", "en", "a"),
        (2, "", "en", "a"), (3, None, "de", "b"), (None, "words without an id", None, "b"),
        (4, LONG, "en", None), (5, "   \n\t ", "fr", ""), (6, "É ÀÉÎ ß straße 漢字 😀 x", "fr", "c"),
        (7, "same text here", "en", "a"), (7, "same text here", "en", "a"), (8, "same  text\there", "en", "b"),
        (9, "x", "en", "a"), (None, None, None, None),
    ]
    return spark.createDataFrame(
        [(i, t, lang, s, len(t) if t else None, "extra", -1, 7, "z", 0, None) for i, t, lang, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, shard string, size int, "
        "position int, label string, rid int, component string")


@pytest.fixture(scope="session")
def write_tables(tmp_path_factory):
    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write
