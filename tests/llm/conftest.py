import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from ``(doc_id, text)`` pairs, with further columns."""
    def make(pairs):
        rows = [(i, text, "en", f"src{n % 3}", len(text or "")) for n, (i, text) in enumerate(pairs)]
        return spark.createDataFrame(rows, FIELDS)

    return make
