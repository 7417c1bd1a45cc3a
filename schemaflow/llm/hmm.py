"""Hidden Markov language model: Baum-Welch counts over all training texts, scaled forward recursion for exact likelihoods.

The states emit classes: one for each of the most frequent training words (a bounded head), one for each group of rarer words
of like endings, one for the end. A rarer word then has its share of its class, by its training count plus one, all unknown
words together one more. So the alphabet of the states is bounded while every word of the corpus keeps its own count: the
counts of rare words reach the documents by a join, never through the driver.

Training is a few passes of expected counts over all training texts; each task adds up its own, Spark sums them by class. Many
texts advance together, one step of the recursion for all of them at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import held_out, stored, table, utf8

HEAD_WORDS = 64_000
# Words seen once stay rare, so that the classes of rare words have the weight that unknown words need.
HEAD_COUNT = 2
TAIL_CLASSES = 1024
ENDING_BYTES = 3
STATES = 8
PASSES = 3
COUNTER_WORDS = 300_000
BLOCK_TOKENS = 400_000
# Words of more bytes stay out of the head, which goes to every task.
HEAD_BYTES = 64
STAY = 0.95


def word_counts(texts: DataFrame) -> DataFrame:
    """word and c over all rows of ``texts`` (text: UTF-8 bytes)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(text.as_py().lower().split())
                if len(counts) > COUNTER_WORDS:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    def rows(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "c"])

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Alphabet:
    """Classes of tokens: head words, then endings, then the end."""

    head: dict[bytes, int]
    head_counts: np.ndarray
    tail_counts: np.ndarray  # training tokens of each ending, without head words
    tail_words: np.ndarray  # distinct training words of each ending, without head words
    ends: int
    endings: dict[bytes, int] = field(default_factory=dict)

    @property
    def end(self) -> int:
        return len(self.head) + len(self.tail_counts)

    @property
    def counts(self) -> np.ndarray:
        return np.concatenate([self.head_counts, self.tail_counts, [self.ends]]).astype(np.float64)

    @property
    def tokens(self) -> int:
        return int(self.counts.sum())

    @property
    def types(self) -> int:
        return len(self.head) + int(self.tail_words.sum()) + (self.ends > 0)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Classes of the words and the end, and the words outside the head."""
        ids = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, len(words))
        places = np.flatnonzero(ids < 0)
        rare = [words[i] for i in places.tolist()]
        ids[places] = [self.ending(w[-ENDING_BYTES:]) for w in rare]
        return np.append(ids, self.end), rare

    def ending(self, last: bytes) -> int:
        found = self.endings.get(last)
        if found is None:
            found = len(self.head) + zlib.crc32(last) % len(self.tail_counts)
            if len(self.endings) < 1 << 20:
                self.endings[last] = found
        return found


def make_alphabet(counts: DataFrame, ends: int, head_words: int, tail_classes: int) -> Alphabet:
    short = F.octet_length("word") <= HEAD_BYTES
    top = counts.filter((F.col("c") >= HEAD_COUNT) & short).orderBy(F.desc("c"), "word").limit(head_words).toArrow()
    head = {w: i for i, w in enumerate(top.column("word").to_pylist())}
    head_counts = np.array(top.column("c").to_pylist(), dtype=np.int64)
    tail_counts, tail_words = np.zeros(tail_classes, np.int64), np.zeros(tail_classes, np.int64)
    ending = F.pmod(F.crc32(F.expr(f"substring(word, -{ENDING_BYTES})")), F.lit(tail_classes))
    for row in counts.groupBy(ending.alias("e")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        tail_counts[row["e"]], tail_words[row["e"]] = row["c"], row["n"]
    for word, c in zip(head, head_counts):
        e = zlib.crc32(word[-ENDING_BYTES:]) % tail_classes
        tail_counts[e] -= c
        tail_words[e] -= 1
    return Alphabet(head, head_counts, tail_counts, tail_words, ends)


def encoded(rows: DataFrame, alphabet: Alphabet) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base, share, classes and rare words of every row.

    ``n_known`` and ``base`` (sum of log10 of count + 1) leave the rare words to the join; ``share`` is the sum of log10 of
    what all words of each rare word's class add up to.
    """
    small = np.uint16 if alphabet.end < 1 << 16 else np.uint32
    kept = rows.select("doc_id", "held_out", "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, " \
             "base double, share double, classes binary, rare array<struct<word: binary, tf: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(alphabet.counts + 1)
        first, last = len(alphabet.head), alphabet.end
        logs[first:last] = 0
        shares = np.zeros(last + 1)
        shares[first:last] = np.log10(alphabet.tail_counts + alphabet.tail_words + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                tokens, known, base, share, classes = [], [], [], [], []
                words, tf, offsets = [], [], [0]
                for text in part.column(2):
                    ids, rare = alphabet.encode(text.as_py().lower().split())
                    tokens.append(len(ids))
                    known.append(len(ids) - len(rare) - (alphabet.ends == 0))
                    base.append(float(logs[ids].sum()))
                    share.append(float(shares[ids].sum()))
                    classes.append(ids.astype(small).tobytes())
                    often = Counter(rare)
                    words += often.keys()
                    tf += often.values()
                    offsets.append(len(words))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(tf, pa.int64())], names=["word", "tf"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(tokens, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base),
                        pa.array(share),
                        pa.array(classes, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base", "share", "classes", "rare"],
                )

    return kept.mapInArrow(run, schema)


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states: probability of the class in the state

    def advance(self, value: np.ndarray | None, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values after one more step of the chains still alive, the step's emissions, and the scales."""
        seen = self.emit[classes]
        value = (self.start if value is None else value[: len(classes)] @ self.move) * seen
        scale = value.sum(axis=1)
        value /= scale[:, None]
        return value, seen, scale

    def forward(self, chains: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each chain of classes, longest first, so that the chains alive at a step are a prefix."""
        total = np.zeros(len(chains))
        grid, alive = stepwise(chains)
        at, value = 0, None
        for n in alive:
            value, _, scale = self.advance(value, grid[at : at + n])
            at += n
            total[:n] += np.log10(scale)
        return total

    def expect(self, chains: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """Add the expected counts of these chains, longest first.

        Forward values are held for a stretch of steps at a time, from the last to the first; what a stretch begins with is known from
        one more forward run, and the backward message passes from stretch to stretch. So a chain of any length is one chain.
        """
        grid, alive = stepwise(chains)
        ends = np.cumsum(alive)
        begins = ends - alive
        stretch = np.flatnonzero(np.diff(begins // BLOCK_TOKENS, prepend=-1))
        firsts, value = [None], None
        for first, last in zip(stretch, stretch[1:]):
            for step in range(first, last):
                value = self.advance(value, grid[begins[step] : ends[step]])[0]
            firsts.append(value)
        later, ahead = np.ones((0, len(self.start))), None
        for first, last, value in zip(stretch[::-1], [len(alive), *stretch[:0:-1]], reversed(firsts)):
            later, ahead = self.backward(grid, begins, ends, range(first, last), value, later, ahead, (start, move, emit))

    def backward(self, grid, begins, ends, steps: range, value, later, ahead, counts: tuple):
        """Expected counts of a stretch of steps; takes and returns the backward values and emissions of the step behind."""
        start, move, emit = counts
        states = len(self.start)
        values, weights = [], []
        for step in steps:
            value, seen, scale = self.advance(value, grid[begins[step] : ends[step]])
            values.append(value)
            weights.append(seen / scale[:, None])
        base = begins[steps[0]]
        shares = np.empty((ends[steps[-1]] - base, states))
        for step in reversed(steps):
            own = values[step - steps[0]]
            back = np.ones((len(own), states))
            if ahead is not None:
                onward = ahead * later
                back[: len(later)] = onward @ self.move.T
                move += own[: len(later)].T @ onward
            share = own * back
            share /= share.sum(axis=1, keepdims=True)
            shares[begins[step] - base : ends[step] - base] = share
            later, ahead = back, weights[step - steps[0]]
        if steps[0] == 0:
            start += shares[: ends[0]].sum(axis=0)
        part = grid[base : ends[steps[-1]]]
        for state in range(states):
            emit[:, state] += np.bincount(part, weights=shares[:, state], minlength=len(emit))
        return later, ahead


def stepwise(chains: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """All classes ordered by step, then chain; and how many chains are alive at each step."""
    lengths = np.array([len(c) for c in chains])
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    begins = np.cumsum(lengths) - lengths
    flat = np.concatenate(chains)
    grid = np.empty_like(flat)
    at = 0
    for step, n in enumerate(alive.tolist()):
        grid[at : at + n] = flat[begins[:n] + step]
        at += n
    return grid, alive.tolist()


def blocks(chains: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Positions of chains of like lengths, longest first, in blocks of bounded size."""
    order = np.argsort([-len(c) for c in chains], kind="stable")
    block, size = [], 0
    for i in order.tolist():
        block.append(i)
        size += len(chains[i])
        if size >= BLOCK_TOKENS:
            yield np.array(block)
            block, size = [], 0
    if block:
        yield np.array(block)


def first_model(alphabet: Alphabet, states: int) -> Model:
    """Sticky states whose emissions scatter at random around the corpus."""
    counts = alphabet.counts + 1
    emit = counts[:, None] * np.random.default_rng(7).uniform(0.5, 1.5, (len(counts), states))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def chains_of(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(c.as_py(), kind).astype(np.int64) for c in column]


def trained(rows: DataFrame, alphabet: Alphabet, states: int, passes: int) -> Model:
    """Baum-Welch over all ``rows`` (classes), with counts summed by class on Spark."""
    model = first_model(alphabet, states)
    kind = np.uint16 if alphabet.end < 1 << 16 else np.uint32
    width, background = alphabet.end + 1, alphabet.counts + 1
    background /= background.sum()
    names = [f"s{i}" for i in range(states)]
    schema = "part int, " + ", ".join(f"{n} double" for n in names)
    for _ in range(passes):
        found = rows.select("classes").mapInArrow(expected(model, kind), schema)
        sums = found.groupBy("part").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
        part = sums.column("part").to_numpy()
        values = np.column_stack([sums.column(n).to_numpy() for n in names]) if len(part) else np.zeros((0, states))
        every = np.zeros((width + states + 1, states))
        every[part] = values
        emit, move, start = every[:width], every[width : width + states], every[-1]
        emit = emit + states * background[:, None]
        move = move + np.eye(states) * STAY + (1 - STAY) / states
        start = start + 1
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def expected(model: Model, kind: type) -> Callable:
    """For each task: one row of expected counts for each class it saw, each state left, and the start."""
    width, states = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.zeros((width + states + 1, states))
        onward = np.zeros((states, states))
        for batch in batches:
            chains = chains_of(batch.column(0), kind)
            for block in blocks(chains):
                model.expect([chains[i] for i in block], every[-1], onward, every[:width])
        every[width : width + states] = onward * model.move
        part = np.flatnonzero(every.any(axis=1))
        columns = [pa.array(part, pa.int32()), *(pa.array(every[part, s]) for s in range(states))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", *(f"s{i}" for i in range(states))])

    return run


def likelihood(classes: Column, model: Model, kind: type) -> Column:
    """log10 likelihood of the classes of each row under the states, by one forward recursion through all of them."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        chains = chains_of(column, kind)
        out = np.zeros(len(chains))
        for block in blocks(chains):
            out[block] = model.forward([chains[i] for i in block])
        return pa.array(out)

    return run.asNondeterministic()(classes)


def score(docs: DataFrame, is_held_out: Column, doc_id: str = "doc_id", text: str = "text", states: int = STATES,
          passes: int = PASSES, head_words: int = HEAD_WORDS, tail_classes: int = TAIL_CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``is_held_out`` (a condition on ``docs``) keeps rows out of training. Null text counts as empty: the end is its only token.
    Ids may be null or repeat; other columns are not read. Without training rows nothing is known and every token has
    a base of 1. No rows give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), is_held_out.alias("held_out"), utf8(text).alias("text"))
    training = rows.filter("not held_out")
    counts = stored(word_counts(training.select("text")), "lm-words")
    alphabet = make_alphabet(counts, training.count(), head_words, tail_classes)
    held = stored(encoded(rows, alphabet).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = held.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
    joined = rare.join(counts, "word").groupBy("row").agg(
        F.sum("tf").alias("rare_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("rare_base")
    )
    model = trained(held.filter("not held_out"), alphabet, states, passes)
    kind = np.uint16 if alphabet.end < 1 << 16 else np.uint32
    scored = held.drop("rare").withColumn("states", likelihood(F.col("classes"), model, kind)).drop("classes")
    both = scored.join(joined, "row", "left").withColumns(
        {"rare_known": F.coalesce("rare_known", F.lit(0)), "rare_base": F.coalesce("rare_base", F.lit(0.0))}
    )
    scale = float(np.log10(alphabet.tokens + alphabet.types + 1))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(alphabet.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_base") - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("states") + F.col("rare_base") - F.col("share")).alias("score"),
    )


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))
