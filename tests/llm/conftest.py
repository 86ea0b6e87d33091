import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parents[1])]

LONG = "lorem ipsum dolor 4111111111111111\n" * 4000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty and long texts, ties, repeated rows, rows without id, and columns that clash with inner names."""
    rows = [
        (1, None, "en"), (2, "", "en"), (3, LONG, "de"), (4, " \n\t ", None), (5, "the same text, twice over\nx", "en"),
        (6, "the same text, twice over\nx", "en"), (6, "the same text, twice over\nx", "en"), (None, "no id here at all", "fr"),
        (8, "a\x1cb 　 漢字 🎉 ▁ é", "fr"), (9, "the same text, twice over\ny z", "de"), (10, "12", "en"),
    ]
    rows = [(i, t, g, "s", len(t or ""), 1.0, 2, "x") for i, t, g in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, score double, lines int, private string",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
