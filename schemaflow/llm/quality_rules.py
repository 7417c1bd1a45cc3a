"""Quality rules: compression bands.

A text that zstandard shrinks far more than prose of its length repeats itself; one that hardly shrinks is noise. Both limits
depend on the length, since longer texts give the compressor more to refer to. Chunks of a fixed size, the last of which ends with
the text, are held against limits of their own, so that a long text cannot hide a repetitive or random part behind a sound one.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import nested, structs, table, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Bands:
    """Bytes up to which a limit holds, and the least and greatest ratio of raw to compressed bytes there.

    The lower limits lie between noise and the labelled good rows of that length. Base64 text of random bytes reaches 1.2 to 1.43,
    hexadecimal text 1.73 at 512 bytes and 1.98 at 64 KB (groups of four digits or more); good rows have at least 1.34 up to 512
    bytes, 1.45 up to 1 KB, 1.66, 1.82, 1.95 up to 8 KB, and 2.16 beyond. So hexadecimal text below 4 KB cannot be told apart.
    The upper limits leave a tenth above good rows. A text goes if more than ``noise_share`` of its chunks hardly shrink, or more
    than ``chunk_share`` do so or shrink too far.
    """

    up_to: tuple[int, ...] = (256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536)
    least: tuple[float, ...] = (0.0, 1.28, 1.42, 1.62, 1.78, 1.93, 2.08, 2.1, 2.12, 2.12)
    most: tuple[float, ...] = (2.2, 2.2, 2.25, 2.35, 2.45, 2.55, 2.65, 2.75, 2.85, 3.0)
    chunk: int = 4096
    chunk_least: float = 1.925
    chunk_most: float = 2.6
    noise_share: float = 0.05
    chunk_share: float = 0.25
    level: int = 3

    def inside(self, size: int, ratio: float) -> bool:
        band = bisect_left(self.up_to, size)
        return self.least[band] <= ratio <= self.most[band]

    def parts(self, size: int) -> list[int]:
        """Where the chunks of a text begin: one after the other, and the last at the end; a shorter text has none."""
        if size < self.chunk:
            return []
        last = size - self.chunk
        return [*range(0, last, self.chunk), last]


# Order and types of the measures of a text.
MEASURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "ratio": pa.float64(),
    "n_chunks": pa.int64(),
    "n_bad_chunks": pa.int64(),
    "n_noise_chunks": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    pair = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, counts = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


class Scorer:
    def __init__(self, bands: Bands):
        self.bands = bands
        self.compressor = zstandard.ZstdCompressor(level=bands.level)

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.compressor.compress(data))

    def measure(self, data: bytes) -> tuple:
        """The measures of a UTF-8 text in their order."""
        bands = self.bands
        words = data.split()
        lines = [line for line in data.split(b"\n") if line.strip()]
        repeated = repeated_words(words)
        ratio = self.ratio(data) if data else 0.0
        parts = bands.parts(len(data))
        shrunk = [self.ratio(data[at : at + bands.chunk]) for at in parts]
        noise = sum(r < bands.chunk_least for r in shrunk)
        bad = noise + sum(r > bands.chunk_most for r in shrunk)
        failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * len(words)
        sound = bands.inside(len(data), ratio)
        sound = sound and noise <= bands.noise_share * len(parts) and bad <= bands.chunk_share * len(parts)
        return (
            len(words),
            len(data.translate(None, SPACES + CONTINUATION)),
            len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated,
            ratio,
            len(parts),
            bad,
            noise,
            failed,
            sound and not failed,
        )


def measures(text: Column, bands: Bands = Bands()) -> Column:
    """The struct of all measures of a binary column of UTF-8 text, computed once per row."""
    kinds = "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, " \
            "ratio: double, n_chunks: long, n_bad_chunks: long, n_noise_chunks: long, base_failed: boolean, kept: boolean>"

    @F.arrow_udf(kinds)
    def measure(texts: pa.Array) -> pa.Array:
        scorer = Scorer(bands)
        rows = [scorer.measure(t.as_py()) for t in texts]
        return structs(dict(zip(MEASURES, zip(*rows) if rows else [()] * len(MEASURES))), MEASURES)

    return measure.asNondeterministic()(text)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """doc_id and the measures of every row, with the verdict ``kept``.

    Null text counts as empty: no words, so it fails. Ids may be null or repeat; other columns are not read. No rows give no
    rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), measures(utf8(text), bands).alias("m"))
    return rows.select("doc_id", *(F.col(f"m.{name}").alias(name) for name in MEASURES))


def keep_sound(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names.

    Null and empty texts have no words and go; repeated rows and ids are judged one by one. No rows give no rows.
    """
    rows = docs.select(nested(docs), measures(utf8(text), bands).alias("m"))
    return rows.filter("m.kept").select("doc.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"))
    first = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select(*first, "ratio", "n_chunks", "n_bad_chunks", "n_noise_chunks")
