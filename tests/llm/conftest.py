import pytest


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and clashing extra columns."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, base + " more", "en", None),
        (3, base + " more", "en", None),
        (4, None, "de", "a"),
        (5, "", None, "b"),
        (6, " \t\n ", "de", "c"),
        (7, "ein wort", "de", "c"),
        (8, "Übung macht den Meister, sagt man.\nZweite Zeile ohne Ende", "de", "a"),
        (None, "no id here but words all the same", "en", "b"),
        (None, None, None, None),
        (9, " ".join(f"long{i % 977}" for i in range(30_000)), "en", "a"),
        (10, "123 456 !!", "en", "a"),
    ]
    extra = [r + (0, 1.0, "x", 7, "y", 3, "t") for r in rows]
    return spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, n_chars long, score double, found string, row_key long, copies string, shard int, _text string"
    )
