"""Spelling variant grouping by finite-state composition.

Words at one edit from each other are what the composition of the vocabulary's acceptor, a transducer of one edit, and the
acceptor again accepts. Its states are (p, edited, q). Before the edit p and q are one state, as both read the same
symbols; after it both go on with equal symbols, and equal states, which minimising makes frequent, accept all they have left.

No task holds the vocabulary: the composition is cut by initial state. Two words with their edit in the second half share
the first half, so the state reached by that half starts a partition; an edit in the first half leaves the second half in common,
and the acceptor read from the end does the same. A partition, then, is a window of positions with what stands before and behind
it; one with more than PARTITION_ROWS words is cut again at the middle of its window. A window of one position holds no more than
all one- and two-letter strings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm.common import stored, table

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
NO_LETTER = re.compile("[^A-Za-zÀ-ÿ]")
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_TIMES = 5
CORRUPT_EVERY = 199
PIECE = 1 << 20
HELD_WORDS = 200_000
PARTITION_ROWS = 20_000
WINDOW = ("lo", "hi", "size", "front", "back")
PAIRS = "a string, a_n long, b string, b_n long"
PAIR_TYPES = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end between runs."""
    at = 0
    while len(text) - at > PIECE:
        gap = NO_LETTER.search(text, at + PIECE)
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def words(doc_id: str, text: str, least: int = LEAST_LETTERS) -> Counter:
    """The words of a text with their counts, a letter of some deleted."""
    runs: Counter = Counter()
    for piece in pieces(text):
        runs.update(RUNS.findall(lowered(piece)))
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) >= least:
            crc = zlib.crc32(run.encode(), start)
            if crc % CORRUPT_EVERY == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < least:
                    continue
            out[run] += n
    return out


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word and n of all words of at least LEAST_LETTERS letters and ``least`` occurrences, over whole texts.

    Null texts have none; a null id counts as the empty text. Extra columns are not read. Counts are summed within tasks, of at most
    HELD_WORDS words at a time, before they are shuffled.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                if t.is_valid:
                    held.update(words(i.as_py(), t.as_py()))
                    if len(held) > HELD_WORDS:
                        yield emitted(held)
                        held = Counter()
        yield emitted(held)

    def emitted(held: Counter) -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=COUNTS)

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Acceptor:
    """The minimal deterministic acceptor of a set of strings: equal right languages are one state.

    ``arcs`` and ``final`` are indexed by state.
    """

    def __init__(self, strings: list[str]):
        """``strings`` sorted and distinct. The states on the path of the last string stay open; others are looked up when left."""
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        letters: list[str] = []

        def close(depth: int) -> None:
            while len(letters) > depth:
                arcs, final = path.pop()
                key = (final[0], tuple(arcs.items()))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.arcs)
                    self.arcs.append(arcs)
                    self.final.append(final[0])
                path[-1][0][letters.pop()] = state

        for string in strings:
            common, most = 0, min(len(letters), len(string))
            while common < most and letters[common] == string[common]:
                common += 1
            close(common)
            for letter in string[common:]:
                path.append(({}, [False]))
                letters.append(letter)
            path[-1][1][0] = True
        close(0)
        self.start = len(self.arcs)
        self.arcs.append(path[0][0])
        self.final.append(path[0][1][0])


class Composition:
    """Acceptor, one deleted or replaced symbol, acceptor: the pairs of strings it accepts, each once.

    Of a pair of equal length the string with the smaller symbol comes first, else the longer one. Where a deleted symbol stands
    among equal neighbours, the last of them counts as deleted.
    """

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final, self.start = acceptor.arcs, acceptor.final, acceptor.start
        self.meets: dict[tuple[int, int], bool] = {}

    def meet(self, p: int, q: int) -> bool:
        """Whether any string is accepted from both states."""
        work = [(p, q) if p < q else (q, p)]
        top = work[0]
        while work:
            p, q = work[-1]
            known = self.meets.get((p, q))
            if known is None:
                # Every state leads to acceptance, so equal states have all their strings in common.
                known = p == q or (self.final[p] and self.final[q])
                if not known:
                    open_pair = None
                    others = self.arcs[q]
                    for symbol, to in self.arcs[p].items():
                        other = others.get(symbol)
                        if other is not None:
                            pair = (to, other) if to < other else (other, to)
                            found = self.meets.get(pair)
                            if found:
                                known = True
                                break
                            if found is None:
                                open_pair = pair
                    if not known and open_pair:
                        work.append(open_pair)
                        continue
                self.meets[p, q] = known
            work.pop()
        return self.meets[top]

    def common(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """The strings accepted from both states; none that starts with ``but``."""
        work = [(p, q, "")]
        while work:
            p, q, read = work.pop()
            if self.final[p] and self.final[q]:
                yield read
            others = self.arcs[q]
            for symbol, to in self.arcs[p].items():
                other = others.get(symbol)
                if other is not None and (read or symbol != but) and self.meet(to, other):
                    work.append((to, other, read + symbol))

    def pairs(self, positions: int) -> Iterator[tuple[str, str, str]]:
        """(left, right, symbol) of all accepted pairs with the edit below ``positions``; symbol: the deleted one if it is the last."""
        work = [(self.start, "")]
        while work:
            state, read = work.pop()
            arcs = self.arcs[state]
            symbols = sorted(arcs)
            for i, a in enumerate(symbols):
                for b in symbols[i + 1 :]:
                    if self.meet(arcs[a], arcs[b]):
                        for rest in self.common(arcs[a], arcs[b]):
                            yield read + a + rest, read + b + rest, ""
                for rest in self.common(arcs[a], state, a):
                    yield read + a + rest, read + rest, "" if rest else a
            if len(read) + 1 < positions:
                work += [(to, read + symbol) for symbol, to in arcs.items()]


def accepted(strings: dict[str, int], window: tuple) -> Iterator[tuple[str, int, str, int]]:
    """Pairs of a partition's words with their counts; ``strings``: what stands in the window of each."""
    lo, hi, size, front, back = window
    if len(strings) < 2:
        return
    length = size - lo - len(back)
    for a, b, last in Composition(Acceptor(sorted(strings))).pairs(hi - lo):
        # Two longer words have a partition of their own; a symbol that the text behind the window repeats is deleted there.
        if len(b) == length and not (last and back.startswith(last)):
            yield front + a + back, strings[a], front + b + back, strings[b]


def windows(vocabulary: DataFrame) -> DataFrame:
    """word, n, size and the whole window lo to hi of every word: once as the shorter or equal, once as the longer of a pair."""
    length = F.length("word")
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    rows = vocabulary.select("word", "n", sizes)
    return rows.select("word", "n", "size", F.lit(0).alias("lo"), (F.col("size") + 1).alias("hi"))


def halves(rows: DataFrame) -> DataFrame:
    """Every window in two, with what stands in front and behind.

    A window holds edit positions ``lo`` to ``hi - 1`` in the longer word of pairs whose shorter word has ``size`` letters; such pairs
    agree in the first ``lo`` and the last ``size - hi`` letters. A window of one position comes once.
    """
    middle = F.shiftright(F.col("lo") + F.col("hi"), 1)
    both = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    cut = rows.select("word", "n", "size", F.explode(both).alias("w")).filter("w.lo < w.hi")
    cut = cut.select("word", "n", "size", "w.lo", "w.hi")
    behind = F.greatest(F.lit(0), F.col("size") - F.col("hi"))
    return cut.withColumns(
        {
            "front": F.substring("word", F.lit(1), F.col("lo")),
            "back": F.when(behind > 0, F.right("word", behind)).otherwise(""),
        }
    )


def partitions(vocabulary: DataFrame, most: int = PARTITION_ROWS) -> DataFrame:
    """word, n and the window of every partition that a word is in, none with more than ``most`` words and two positions.

    Large partitions are cut until none is left; the driver sees one flag a round, and there are as many rounds as the longest word can
    be halved.
    """
    done = None
    rows = stored(halves(windows(vocabulary)), "spelling-windows")
    while True:
        counts = rows.groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("held"))
        large = counts.filter((F.col("held") > most) & (F.col("hi") - F.col("lo") > 1)).select(*WINDOW)
        large = stored(large, "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, list(WINDOW), "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = stored(halves(rows.join(large, list(WINDOW), "left_semi")), "spelling-windows")


def near_pairs(vocabulary: DataFrame, most: int = PARTITION_ROWS) -> DataFrame:
    """a, a_n, b, b_n of every two words at one inserted, deleted or replaced letter, once; a is the longer or smaller one.

    ``vocabulary``: distinct words with n. Partitions of one word give nothing and are not looked at.
    """

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        key, held = None, {}

        def close() -> None:
            if key is not None:
                found.extend(accepted(held, key))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in WINDOW]
            inside = batch.column("inside").to_pylist()
            n = batch.column("n").to_pylist()
            for at, own in enumerate(zip(*columns)):
                if own != key:
                    close()
                    key, held = own, {}
                    if len(found) >= 50_000:
                        yield listed(found)
                        found = []
                held[inside[at]] = n[at]
        close()
        yield listed(found)

    def listed(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PAIR_TYPES.types)], schema=PAIR_TYPES)

    behind = F.length("back")
    inside = F.substring("word", F.col("lo") + 1, F.length("word") - F.col("lo") - behind).alias("inside")
    rows = partitions(vocabulary, most).select(*WINDOW, "n", inside)
    return rows.repartition(*WINDOW).sortWithinPartitions(*WINDOW).mapInArrow(compose, PAIRS)


def variants(vocabulary: DataFrame, times: int = FORM_TIMES, most: int = PARTITION_ROWS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``vocabulary`` (distinct word, n).

    ``form``: the near word of greatest n, ties to the smallest, if that n is at least ``times`` the word's, else null; with a factor
    above 1 n grows with every step, so chains of forms end. ``root``: the end of the word's chain, reached by doubling steps. No rows
    give no rows.
    """
    if times <= 1:
        raise ValueError("chains of forms end only if n grows with every step")
    pairs = stored(near_pairs(vocabulary, most), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    chosen = -F.col("best.minus") >= times * F.col("n")
    joined = stored(
        vocabulary.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best.near")).alias("form"),
            F.when(chosen, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    links = joined.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        stepped = stored(stepped, "spelling-roots")
        links = stepped.select("word", "root")
        if stepped.filter("next IS NOT NULL").isEmpty():
            break
    return joined.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(vocabulary(table(spark, sf_dir, "documents")), "spelling-words")
    return variants(found)


# crc32 has no function in this SQL: the bits of "<doc_id>:<run>", lowest first, are folded one by one. Words at one edit
# become equal, or equal to one another, when one letter is taken out.
ORACLE = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
), coded AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM lowered
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS INTEGER)),
           lambda b: list_transform(range(8), lambda k: (b >> k) & 1)))),
           lambda a, b: xor(a >> 1, CASE WHEN (xor(a, b) & 1) = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM coded
), corrupted AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
              ELSE run END AS word, n FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM corrupted WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), d AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM v, LATERAL (SELECT unnest(range(length(word))) AS i)
), pairs AS (
  SELECT x.word, y.word AS near, y.n FROM d x JOIN d y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word
), near AS (
  SELECT word, count(*) AS n_near, max(n) AS best_n, arg_min(near, {'m': -n, 'w': near}) AS best FROM pairs GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form,
         CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL
)
SELECT formed.word, form, chain.at AS root, n, n_near, form_n
FROM formed JOIN chain ON chain.word = formed.word
WHERE chain.at IN (SELECT word FROM formed WHERE form IS NULL)
"""
