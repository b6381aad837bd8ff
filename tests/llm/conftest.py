import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000 + "end"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns whose names
    clash with what the operators return or use inside."""
    rows = [(1, "a b c d e", "en", "s1"), (2, "a b c d e", "en", "s1"), (2, "a b c d e", "en", "s1"), (3, None, "en", "s2"),
            (4, "", None, None), (5, " \t\n ", "fr", "s2"), (None, "null id text here", "fr", "s3"), (6, LONG, "en", "s1"),
            (7, "ünï ▁ 漢字 \U0001f600 text", "de", "s3"), (8, "one", "de", None), (None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, size long, shard string, id string, fp string, component int, " \
             "th string, runs string, key string, token_ids string, score string, n long, reps string"
    return spark.createDataFrame([(*r, 1, "x", "i", "f", 0, "t", "r", "k", "z", "q", 5, "m") for r in rows], schema)


@pytest.fixture()
def no_documents(odd_documents):
    return odd_documents.limit(0)
