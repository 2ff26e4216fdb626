"""Spelling variants: words one edit apart, found over a reduced alphabet."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import staged

# Symbols that letters are hashed to, and the shortest word.
SYMBOLS = 8
LEAST_LENGTH = 7
# Distinct words that a task counts before it sends them on.
HELD = 100_000
# Neighbours that are made at once, so that a very long word needs little memory.
PART = 1 << 20

# The letters of a word, those that are lowered, and the law of the deliberate slips.
LETTERS = r"A-Za-zÀ-ÿ"
SLIP = 31
_lower = {i: i + 32 for i in range(65, 91)}

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def slipped(identity: int, run: str) -> str:
    """The run with the letter deleted that the law of its document and itself names, if it names one.

    ``identity`` is the checksum of the document's id and a colon.
    """
    h = zlib.crc32(run.encode(), identity)
    if h % SLIP:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def vocabulary(
    df: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = 2, slips: bool = True,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Words of ``least_length`` or more letters and how often they stand in all texts: ``word, n``.

    Tasks send counts of the distinct words of many texts, never single words.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")  # a longer run is matched whole

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def send() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                identity = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                found: Counter = Counter()
                for run, n in Counter(map(itemgetter(0), runs.finditer(text or ""))).items():
                    found[run.lower() if run.isascii() else run.translate(_lower)] += n
                for run, n in found.items():
                    word = slipped(identity, run) if slips else run
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD:
                    yield send()
        yield send()

    source = df.select(F.col(id_column).cast("string").alias("doc"), F.col(text_column).alias("text"))
    counted = source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def reduced(words: list[str], symbols: int = SYMBOLS) -> list[np.ndarray]:
    """Letters of each word as symbols from 1 to ``symbols``."""
    if not words:
        return []
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    hashed = (points * np.uint64(2654435761) >> np.uint64(16)) % np.uint64(symbols) + np.uint64(1)
    return np.split(hashed, np.cumsum([len(w) for w in words])[:-1])


def spelled(rows: np.ndarray) -> np.ndarray:
    """One number per row of symbols: the sum of each symbol times the base to the power of its place."""
    powers = _powers(BASE, rows.shape[1])
    return (rows * powers[:-1]).sum(1, dtype=np.uint64)


def neighbourhood(row: np.ndarray, symbols: int = SYMBOLS) -> Iterator[np.ndarray]:
    """Numbers of the words one edit away from some words of symbols of equal length, as rows with repeats.

    Each word gives itself, all words with one symbol less, and those with one symbol replaced by a higher one.
    The rest of its neighbourhood - longer words and lower symbols - has the word in its own, so each pair of
    neighbours is met once.
    """
    length = row.shape[1]
    powers = _powers(BASE, length)
    terms = row * powers[:-1]
    total = terms.sum(1, dtype=np.uint64)[:, None]
    yield total
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    if length > 1:
        yield (before - terms) + (total - before) * INVERSE
    for up in range(1, symbols):
        made = total + np.uint64(up) * powers[:-1]
        # A symbol that would be none is left as it is: the word itself, which is there already.
        yield np.where(row + np.uint64(up) <= np.uint64(symbols), made, total)


def _powers(base: np.uint64, length: int) -> np.ndarray:
    powers = np.full(length + 1, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _keyed(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, key), where the key is the number of the reduced word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.empty(batch.num_rows, dtype=np.int64)
            for places, rows in _by_length(batch.column("word").to_pylist(), symbols):
                keys[places] = spelled(rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(work, "word string, n long, key long")


def _by_length(words: list[str], symbols: int) -> Iterator[tuple[list[int], np.ndarray]]:
    made = reduced(words, symbols)
    groups: dict[int, list[int]] = {}
    for i, row in enumerate(made):
        groups.setdefault(len(row), []).append(i)
    for places in groups.values():
        yield places, np.stack([made[i] for i in places])


def _neighbours(reduced_words: DataFrame, symbols: int) -> DataFrame:
    """(key, near) of every reduced word, itself included; ``reduced_words`` has ``key`` and a ``word`` of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, keys = batch.column("word").to_pylist(), batch.column("key").to_numpy()
            for places, rows in _by_length(words, symbols):
                at = max(1, PART // (rows.shape[1] * symbols))
                for start in range(0, len(places), at):
                    near = np.sort(np.concatenate(list(neighbourhood(rows[start : start + at], symbols)), axis=1), axis=1)
                    new = np.concatenate([np.ones((len(near), 1), dtype=bool), near[:, 1:] != near[:, :-1]], axis=1)
                    own = np.repeat(keys[places[start : start + at]], new.sum(1))
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(near[new].astype(np.int64))], names=["key", "near"])

    return reduced_words.select("key", "word").mapInArrow(work, "key long, near long")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Pairs of words exactly one inserted, deleted or replaced letter apart, each once: ``a, a_n, b, b_n``.

    ``words`` has distinct ``word`` and ``n``. Letters are hashed to ``symbols`` symbols. Each distinct reduced word
    has its neighbourhood generated once, as numbers, and these meet the reduced words in a join. The words behind
    two neighbouring reduced words are then compared in full. A word is in one reduced word and a pair of reduced
    words is met once, so no pair is found twice.
    """
    keyed = staged(_keyed(words, symbols), "words")
    few = staged(keyed.groupBy("key").agg(F.min("word").alias("word")), "reduced")
    met = _neighbours(few, symbols).join(few.select(F.col("key").alias("near")).hint("merge"), "near")
    a, b = (keyed.select(F.col("key").alias(key), F.col("word").alias(s), F.col("n").alias(f"{s}_n")) for s, key in (("a", "key"), ("b", "near")))
    pairs = met.join(a.hint("merge"), "key").join(b.hint("merge"), "near")
    # Two words of one reduced word meet both ways; others one way only.
    apart = "(key <> near or a < b) and abs(length(a) - length(b)) <= 1 and levenshtein(a, b, 1) = 1"
    return pairs.where(apart).select("a", "a_n", "b", "b_n")


def variants(
    df: DataFrame, symbols: int = SYMBOLS, ratio: int = 10, least_length: int = LEAST_LENGTH, least_count: int = 2,
    slips: bool = True, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Words of all texts, the more frequent word each is a variant of, and the root it leads to.

    A word is a maximal run of letters, A-Z lowered; with ``slips``, one in ``SLIP`` of the runs of a document
    has a letter deleted first, as a checksum of the document's id and the run says. Words of ``least_length``
    or more letters with ``least_count`` or more occurrences count. The form of a word is the most frequent word one
    edit away, of several the first in code-point order, if it is ``ratio`` times as frequent. The root is what
    the forms lead to; each step multiplies the frequency, so a few doublings of the steps reach it.

    Null and empty texts have no words; a null id counts as an empty one. Rows that are repeated count each time.
    Very long runs are words like others. Other columns are ignored; an empty table gives no rows.
    Returns ``word, n, n_near, form, form_n, root``.
    """
    words = staged(vocabulary(df, least_length, least_count, slips, id_column, text_column), "vocabulary")
    pairs = staged(near_words(words, symbols), "near")
    sides = pairs.unionByName(pairs.selectExpr("b as a", "b_n as a_n", "a as b", "a_n as b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")))
    near = sides.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near.hint("merge"), "word", "left").withColumn("far", -F.col("best.less") >= ratio * F.col("n"))
    known = staged(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("far"), F.col("best.form")).alias("form"), F.when(F.col("far"), -F.col("best.less")).alias("form_n"),
    ), "forms")
    # Only words with a form take part in the steps; the others are roots.
    steps = known.where("form is not null").select("word", F.col("form").alias("to"))
    while True:
        onward = steps.select(F.col("word").alias("to"), F.col("to").alias("further")).hint("merge")
        steps = staged(steps.join(onward, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "steps")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    roots = steps.select("word", F.col("to").alias("root")).hint("merge")
    return known.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
