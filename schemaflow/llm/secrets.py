"""Secret scans: a keyword automaton, anchored patterns near its hits, and checksums inside tokens.

One Aho-Corasick pass over a text finds every keyword. A pattern is only tried where one of its keywords stands, anchored at
that place; each pattern begins with its keyword, so this finds what a search of the whole text would. Runs of hex digits have
no keyword: they are found as bytes, by jumping through the text in steps of the shortest run that counts. Tokens with an
embedded checksum count only if it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import structs, table, utf8

# Kinds in the order in which equal starts are listed, their keywords, patterns and least lengths.
KINDS = ("assign", "access", "hex", "forge", "package")
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
FORGE = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
PACKAGE = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
VALUE_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = re.compile(rb"[0-9a-f]+")
HEX_DIGITS = frozenset(b"0123456789abcdef")


def base62(value: int, width: int) -> str:
    digits = ""
    for _ in range(width):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def checksum_holds(found: re.Match) -> bool:
    """The last six characters are the CRC-32 of the body in base 62."""
    return base62(zlib.crc32(found[1].encode()), 6) == found[2]


RULES = {
    "assign": (ASSIGN_KEYWORDS, ASSIGN, lambda m: len(m[2]) >= VALUE_LENGTH),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= ACCESS_LENGTH),
    "forge": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), FORGE, checksum_holds),
    "package": (("npm_",), PACKAGE, checksum_holds),
}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            built.add_word(word, (kind, len(word)))
    built.make_automaton()
    return built


UPPER_ASCII = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lowered(text: str) -> str:
    """Lower case with every character at its old place."""
    small = text.lower()
    return small if len(small) == len(text) else text.translate(UPPER_ASCII)


def keyword_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and kind of each pattern, leftmost and non-overlapping within its kind."""
    hits: dict[str, list[int]] = {}
    for last, (kind, length) in automaton().iter(lowered(text)):
        hits.setdefault(kind, []).append(last + 1 - length)
    for kind, starts in hits.items():
        _, pattern, accepts = RULES[kind]
        free = 0
        for start in sorted(starts):
            if start >= free and (found := pattern.match(text, start)):
                free = found.end()
                if accepts(found):
                    yield start, found.end(), kind


def hex_spans(text: str, data: bytes) -> Iterator[tuple[int, int, str]]:
    """Runs of at least 24 digits. Each holds the last byte of one of the blocks of 24 bytes, and so do others around it."""
    samples = data[HEX_LENGTH - 1 :: HEX_LENGTH].translate(SAMPLED)
    free, at = 0, samples.find(b"\x01")
    while at >= 0:
        place = at * HEX_LENGTH + HEX_LENGTH - 1
        if place >= free:
            first = place
            while first > 0 and data[first - 1] in HEX_DIGITS:
                first -= 1
            last = HEX_RUN.match(data, place).end()
            free = last
            if last - first >= HEX_LENGTH:
                start = first if len(data) == len(text) else len(data[:first].decode())
                yield start, start + last - first, "hex"
        at = samples.find(b"\x01", at + 1)


SAMPLED = bytes(int(b in HEX_DIGITS) for b in range(256))


def spans(data: bytes) -> list[tuple[int, int, str]]:
    """All spans of a UTF-8 text in code points, by start, then kind in the listed order."""
    text = data.decode()
    found = [*keyword_spans(text), *hex_spans(text, data)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def span_column(text: Column) -> Column:
    """array<struct<start, end, kind>> of a binary column of UTF-8 text, computed once per row."""
    kinds = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    @F.arrow_udf("array<struct<start: long, end: long, kind: string>>")
    def scan(texts: pa.Array) -> pa.Array:
        counts, flat = [0], []
        for text in texts:
            flat += spans(text.as_py())
            counts.append(len(flat))
        columns = dict(zip(("start", "end", "kind"), zip(*flat) if flat else ((), (), ())))
        values = structs(columns, {f.name: f.type for f in kinds})
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)

    return scan.asNondeterministic()(text)


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans of every row.

    Null and empty texts have no spans. Ids may be null or repeat; other columns are not read. No rows give no rows.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), span_column(utf8(text)).alias("spans"))


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The same rows and columns with every secret of ``text`` replaced by its kind in brackets, and ``length`` (its number
    of characters) renewed. Rows without secrets, null and empty texts, repeated rows and all other columns stay as they are.
    No rows give no rows.
    """

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None else without(t) for t in texts.to_pylist()], pa.string())

    clean = docs.withColumn(text, cleaned.asNondeterministic()(F.col(text)))
    return clean.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType)) if length else clean


def without(text: str) -> str:
    """Overlapping spans become one, named by the kind that starts first."""
    parts, free = [], 0
    for start, end, kind in spans(text.encode()):
        if start >= free:
            parts += [text[free:start], f"[{kind}]"]
        free = max(free, end)
    return "".join([*parts, text[free:]])


def joined(found: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(of_kinds(F.col("spans"), kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(of_kinds(F.col("spans"), *base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
