"""Texts with a run of white space that the faster encoder's pattern engine cannot take."""

from __future__ import annotations

import numpy as np
import pytest
from test_packing import compare
from tokenizers import Tokenizer

from schemaflow.llm import packing
from schemaflow.llm.tokens import LONG_SPACE, document_ids


@pytest.mark.parametrize(
    "text",
    [
        " " * 1_200_000 + "a",
        "a\n" + "\n" * 1_200_000,
        "é" + "\xa0\x85" * 600_000 + "b",
        "a" + " " * LONG_SPACE + "b",
        "a" + " " * (LONG_SPACE - 1) + "b",
        ("a" + " " * (LONG_SPACE - 1)) * 3,
    ],
    ids=["spaces", "newlines", "low-latin", "at-limit", "below-limit", "several-below"],
)
def test_ids_are_those_of_the_tokenizer(text):
    encode = document_ids(packing.VOCABULARY, packing.RANKS)
    want = Tokenizer.from_file(packing.VOCABULARY).encode(text, add_special_tokens=False).ids
    assert np.array_equal(np.frombuffer(encode(text.encode()), "<u4"), np.array(want, dtype="<u4"))


def test_one_such_text_does_not_end_the_job(spark, documents):
    rows = [(1, "one text"), (2, " " * 1_200_000 + "a"), (3, None), (4, "another text")]
    compare(documents(rows), rows)
