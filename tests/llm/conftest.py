import random

import pytest

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows."""

    def make(rows):
        full = [
            (doc_id, text, "en", source, None if text is None else len(text))
            for doc_id, text, source in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Empty and blank texts, odd white space, long words, and long texts."""
    random.seed(5)
    words = ["alpha", "beta", "Gamma", "délta", " x", "1.2.3.4", "a@b.co", "+1", "|", "!!"]
    return [
        None,
        "",
        " \t\n",
        "one",
        "one two",
        "One\x0btwo three\nONE",
        "x" * 120_000,
        "9" * 60_000,
        "a." * 40_000,
        "a@" * 20_000 + "b." * 20_000 + "c",
        "word " * 50_000,
        " ".join(random.choices(words, k=3000)),
        "\n".join(" ".join(random.choices(words, k=7)) for _ in range(300)),
    ]
