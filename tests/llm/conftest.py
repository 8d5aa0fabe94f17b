import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, part int, label string, ids string, "
    "length int, digest string, removed string, score string, edge long, size int, start string"
)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang) as documents, with further columns whose names operators use inside."""

    def make(rows):
        rest = (1, "x", "y", 2, "z", "r", "s", 3, 4, "t")
        full = [(i, t, lang, "src", len(t) if t is not None else None, *rest) for i, t, lang in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    """NULLs, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i} tail{i % 13}." for i in range(20_000))
    same = "The same words stand here twice, and here they are.\nA second line follows the first one at once."
    return [
        (1, same, "en"),
        (1, same, "en"),
        (2, same, "en"),
        (3, None, "en"),
        (4, "", None),
        (5, long_text, "en"),
        (6, "... 123 !?", "de"),
        (7, " \n\t ", "fr"),
        (None, same, "en"),
        (None, None, None),
        (8, "x" * 50_000, "en"),
        (9, "Ein kurzer Satz über große Tiere.", "de"),
        (10, "<|endoftext|> inside \\### text </turn>", "en"),
    ]
