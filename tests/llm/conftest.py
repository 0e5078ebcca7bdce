import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from countloom.session import local_session

    session = local_session("tests", "8", "6g")
    session.sparkContext.setLogLevel("OFF")
    return session


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, rank string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977} and" for i in range(12_000)) + "x" * 40_000
    near = " ".join(f"t{i}" for i in range(200))
    rows = [
        (1, "", "en", "a"), (2, None, "en", "a"), (None, "a b c d e f g", None, None), (4, long_text, "en", "b"),
        (4, long_text, "en", "b"), (5, near, "fr", None), (6, near.replace("t100", "u100"), "fr", "c"), (7, near, "xx", "a"),
        (8, " \t\n ", "de", "a"), (9, "one two", "es", "b"), (10, "Σ İ ß <|endoftext|> 漢字 'll we've!!", "de", "\U0001f600"),
    ]
    return spark.createDataFrame([(*r, None, "s", "x", None) for r in rows], SCHEMA)
