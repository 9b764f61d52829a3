import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lakestrata.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def corpus(spark):
    return prepare(spark)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(corpus):
    """Nulls in every column, empty, blank, very long and repeated texts, and columns named like results."""
    long = "lorem ipsum dolor sit amet " * 4000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "s", 44),
        (1, "The quick brown fox jumps over the lazy dog.", "en", "s", 44),
        (2, None, None, None, None),
        (3, "", "en", "s", 0),
        (4, " \n\t ", "en", "s", 4),
        (None, "Ein Text ohne Nummer und ohne Namen.", "de", "s", 36),
        (5, long, "la", "s", len(long)),
        (6, "x" * 50_000, None, "s", 50_000),
        (7, "...!!! 12 -- é́ \U0001f642", "en", None, 20),
    ]
    df = corpus.createDataFrame(rows, DOCS)
    clash = "score predicted r spans items lang_pred n_tokens ids key node class_id train block fingerprint text_".split()
    return df.selectExpr("*", *[f"'{c}' as {c}" for c in clash])


@pytest.fixture(scope="session")
def no_docs(corpus):
    return corpus.createDataFrame([], DOCS)
