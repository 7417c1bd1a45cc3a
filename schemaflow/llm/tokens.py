"""Token ids of whole documents by a public vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

# Below U+0240 all versions of the Unicode tables agree on what is a letter, a number or a space.
FIRST_UNSURE_LEAD = 0xC9
# The faster encoder's pattern engine keeps a state for each character of a run of white space and fails at about a million.
LONG_SPACE = 100_000
SPACES = re.compile(r"(?<!\s)\s{%d}" % LONG_SPACE)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def document_ids(vocabulary: str, ranks: str) -> Callable[[bytes], bytes]:
    """A function from UTF-8 text to ids, as the tokenizer file gives them, in little-endian unsigned 32-bit integers.

    ``ranks`` holds the same vocabulary for an encoder that is several times faster. It serves texts of characters below
    U+0240 without what might be a special token or a very long run of white space; all others go to the tokenizer itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(vocabulary)
    fast = tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks), special_tokens={}
    )

    def encode(text: bytes) -> bytes:
        if not text:
            return b""
        if b"<|" not in text and np.frombuffer(text, np.uint8).max() < FIRST_UNSURE_LEAD:
            plain = text.decode()
            if len(plain) < LONG_SPACE or not SPACES.search(plain):
                return np.array(fast.encode_ordinary(plain), dtype="<u4").tobytes()
        ids = slow.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    return encode
