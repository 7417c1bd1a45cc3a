from __future__ import annotations

import base64
import os
import random
import re
from collections import Counter

import pytest
import zstandard
from edge_texts import EDGE
from pyspark.sql import functions as F

from schemaflow.llm import quality_rules as rules
from schemaflow.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def verdict(text, bands=rules.Bands()):
    """The bands in plain steps."""
    data = text.encode()

    def ratio(part):
        return len(part) / len(zstandard.ZstdCompressor(level=bands.level).compress(part))

    if brute(text)[5]:
        return False
    band = sum(len(data) > limit for limit in bands.up_to)
    if not bands.least[band] <= ratio(data) <= bands.most[band]:
        return False
    parts = [data[i : i + bands.chunk] for i in range(0, len(data), bands.chunk)]
    if len(data) >= bands.chunk and len(parts[-1]) < bands.chunk:
        parts[-1] = data[-bands.chunk :]
    parts = [p for p in parts if len(p) == bands.chunk]
    noise = [p for p in parts if ratio(p) < bands.chunk_least]
    bad = noise + [p for p in parts if ratio(p) > bands.chunk_most]
    return len(noise) <= bands.noise_share * len(parts) and len(bad) <= bands.chunk_share * len(parts)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = rules.op9_quality_rules(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(text[r.doc_id]), r
        assert r.kept == verdict(text[r.doc_id])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_labelled_good_documents_stay(spark, sf):
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    rows = rules.op9_quality_rules(spark, sf).join(good, "doc_id").filter("not base_failed").collect()
    assert all(r.kept for r in rows)


@pytest.mark.parametrize("seed", range(40))
def test_random_words(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["a", "b", "c", "é", " ", " ", "\n", "#", "\x0b", "\x85"]) for _ in range(r.randint(0, 200)))
    assert rules.Scorer(rules.Bands()).measure(text.encode())[:5] == brute(text)[:5]


def test_repetition_and_noise_go():
    r = random.Random(1)
    prose = " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(3000))
    scorer = rules.Scorer(rules.Bands())
    assert scorer.measure(prose.encode())[-1]
    halves = prose[: len(prose) // 2] + " " + " ".join(f"{i % 7} lorem ipsum {i % 5} dolor" for i in range(2000))
    assert not scorer.measure(halves.encode())[-1]
    noise = " ".join(os.urandom(4).hex()[:7] + chr(0x4E00 + r.randrange(20000)) * 3 for _ in range(2000))
    assert scorer.measure(noise.encode())[-1] == verdict(noise)


def grouped(data, size, group):
    return " ".join(data[i : i + group] for i in range(0, len(data), group))[:size]


def noise_of(kind, size, group, r):
    raw = r.randbytes(size)
    return grouped(base64.b64encode(raw).decode() if kind == "base64" else raw.hex(), size, group)


def sound_text(spark, size):
    """Labelled good prose of the tables, joined to so many bytes."""
    sf = "/root/testdata/sf0.1"
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    rows = table(spark, sf, "documents").filter("lang = 'en'").join(good, "doc_id").orderBy("doc_id").limit(400).collect()
    return " ".join(r.text for r in rows)[:size]


def test_noise_goes(spark):
    """Alone, in front of prose, behind it, and as its half; base64 from 1 KB, hexadecimal text from 4 KB."""
    r = random.Random(7)
    scorer = rules.Scorer(rules.Bands())
    prose = sound_text(spark, 150_000)
    for size in (2100, 9000, 20_000, 64_000, 140_000):
        assert scorer.measure(prose[:size].encode())[-1], size
    for kind, sizes in (("base64", (1024, 1500, 2048, 4096, 6000, 8192, 16_384, 65_536)), ("hex", (4096, 6000, 8192, 16_384, 65_536))):
        for size in sizes:
            for group in (4, 6, 8, 16):
                noise = noise_of(kind, size, group, r)
                own = prose[:size]
                texts = {"alone": noise, "head": noise + " " + own, "tail": own + " " + noise}
                texts["half"] = own[: size // 2] + " " + noise + " " + own[size // 2 :]
                for place, text in texts.items():
                    if place == "half" and kind == "hex" and size < 8192:
                        continue  # no whole chunk of noise, and no ratio that good texts do not have
                    assert scorer.measure(text.encode())[-1] is False, (kind, size, group, place)


def test_columns_of_any_name_stay(spark, documents):
    docs = documents([(1, sound_text(spark, 3000)), (2, "short")]).withColumn("__m", F.lit(5)).withColumn("m", F.lit("x"))
    kept = rules.keep_sound(docs.withColumn("doc", F.lit(1)))
    assert [(r.doc_id, r["__m"], r.m, r.doc) for r in kept.collect()] == [(1, 5, "x", 1)]


def test_edges(spark, documents):
    rows = rules.judge(documents(EDGE)).collect()
    assert len(rows) == len(EDGE)
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert rules.judge(documents([])).collect() == []
    kept = rules.keep_sound(documents([(1, None), (2, "plain words of some length " * 40)]))
    assert kept.columns == documents([]).columns
