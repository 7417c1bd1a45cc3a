from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
if HERE not in sys.path:
    sys.path.insert(0, HERE)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, shard int, words string, row long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table like ``documents`` from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(pairs, lang="en", source="src0"):
        rows = [(i, t, lang, source, None if t is None else len(t), 9, "extra", 5) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
