"""Benchmark items in training texts: BM25 over the items with block-max WAND, then overlap of question and answer."""

import re
from collections import Counter
from functools import lru_cache
from math import ceil, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import columns_added, staged

# Usual BM25 parameters, and words of a shingle.
K1, B, WORDS = 1.2, 0.75, 5
# Items whose scores one bound covers.
BLOCK = 16
# A term that more than this share of the items contains is only counted in full once a bound is passed.
COMMON = 0.1
# Characters of the items that are searched for in one pass over the texts.
PASS_CHARS = 4_000_000

LEAKS = "array<struct<item_id: long, score: double, question: double, answer: double>>"

_word = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _word.findall((text or "").lower())


def _shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))} if words else set()


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the answer is the last sentence or line, if there are several."""
    pieces = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if words_of(p)]
    if len(pieces) < 2:
        return words_of(text), []
    return words_of(" ".join(pieces[:-1])), words_of(pieces[-1])


class Index:
    """Inverted index of items, scores scaled so that an item is retrieved from 1 on.

    An item's threshold is what a passage must score that holds at least ``percent`` per cent of the item's
    shingles: a missing word spoils at least one shingle, so the full score less the largest weights of as
    many terms as there may be spoilt shingles. Items are sorted by length and cut into blocks; each block has
    the passage length that its longest item needs.
    """

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.percent = percent
        kept = sorted(((i, t, words_of(t)) for i, t in items if words_of(t)), key=lambda x: (len(x[2]), x[0] is not None, x[0] or 0, x[1]))
        self.ids = [i for i, _, _ in kept]
        self.parts = [tuple(_shingles(p) for p in parts(t)) for _, t, _ in kept]
        self.whole = [_shingles(w) for _, _, w in kept]
        counts = [Counter(w) for _, _, w in kept]
        spread = Counter(term for c in counts for term in c)
        n, mean = len(kept), sum(len(w) for _, _, w in kept) / max(1, len(kept))
        self.terms = {term: k for k, term in enumerate(sorted(spread))}
        idf = {term: log(1 + (n - m + 0.5) / (m + 0.5)) for term, m in spread.items()}
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for place, ((_, _, words), count) in enumerate(zip(kept, counts)):
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(words) / mean)) for t, f in count.items()}
            runs = max(1, len(words) - WORDS + 1)
            spoilt = len(self.whole[place]) * (100 - percent) // 100 + runs - len(self.whole[place])
            largest = sorted(weight.values(), reverse=True)
            least = max(sum(largest[spoilt:]), largest[-1]) * (1 - 1e-9)
            for term, w in weight.items():
                self.postings[self.terms[term]].append((place, w / least))
        self.blocks = -(-n // BLOCK)
        longest = [max(len(kept[i][2]) for i in range(b * BLOCK, min(n, (b + 1) * BLOCK))) for b in range(self.blocks)]
        # A passage is four steps long, twice the longest item, and the next one starts a step later.
        self.step = np.array([ceil(length / 2) for length in longest], dtype=np.int64)
        rare = [m <= max(1, COMMON * n) for m in (spread[t] for t in self.terms)]
        common = np.zeros(n)
        columns, weights = [], []
        self.rare_ids = np.full(len(self.terms), -1, dtype=np.int64)
        starts = [0]
        # Per term, the largest weight in each block and in all: the bounds of the search.
        self.block_most = [self._blocks(posting) for posting in self.postings]
        self.most = [max(best.values()) for best in self.block_most]
        for term, best in enumerate(self.block_most):
            if rare[term]:
                self.rare_ids[term] = len(starts) - 1
                columns += best.keys()
                weights += best.values()
                starts.append(len(columns))
            else:
                for place, w in self.postings[term]:
                    common[place] += w
        # The bounds of the rare terms, as the rows of a sparse matrix of terms and blocks.
        self.starts = np.array(starts, dtype=np.int64)
        self.columns, self.weights = np.array(columns, dtype=np.int64), np.array(weights)
        self.rest = np.array([common[b * BLOCK : (b + 1) * BLOCK].max() for b in range(self.blocks)]) if n else np.zeros(0)

    @staticmethod
    def _blocks(posting: list[tuple[int, float]]) -> dict[int, float]:
        best: dict[int, float] = {}
        for place, w in posting:
            best[place // BLOCK] = max(best.get(place // BLOCK, 0.0), w)
        return best

    def passages(self, terms: np.ndarray) -> list[tuple[int, int]]:
        """Block and step of all passages whose bound reaches 1, from the terms of a text (-1: not in the index)."""
        at = np.flatnonzero(terms >= 0)
        rare = self.rare_ids[terms[at]]
        at, rare = at[rare >= 0], rare[rare >= 0]
        found: list[tuple[int, int]] = [
            (b, j) for b in np.flatnonzero(self.rest >= 1).tolist() for j in range(-(-len(terms) // int(self.step[b])))
        ]
        if len(at):
            sizes = self.starts[rare + 1] - self.starts[rare]
            own = np.repeat(np.arange(len(at)), sizes)
            entry = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[rare], sizes)
            block, weight = self.columns[entry], self.weights[entry]
            last = at[own] // self.step[block]
            width = int(last.max()) + 1
            total = np.zeros(self.blocks * width)
            for back in range(4):
                some = last >= back
                total += np.bincount(block[some] * width + last[some] - back, weight[some], minlength=len(total))
            over = np.flatnonzero(total.reshape(self.blocks, width) + self.rest[:, None] >= 1)
            found += [(k // width, k % width) for k in over.tolist() if self.rest[k // width] < 1]
        return found

    def search(self, terms: set[int]) -> list[tuple[int, float]]:
        """Places of all items that score at least 1 for the terms of a passage, by block-max WAND."""
        lists = [[self.postings[t], 0, self.most[t], self.block_most[t]] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            bound, pivot = 0.0, None
            for k, (posting, at, most, _) in enumerate(lists):
                bound += most
                if bound >= 1:
                    pivot = k
                    break
            if pivot is None:
                break
            place = lists[pivot][0][lists[pivot][1]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][1]][0] == place:
                pivot += 1
            block = place // BLOCK
            if sum(x[3].get(block, 0.0) for x in lists[: pivot + 1]) < 1:
                # No item up to the end of the block, or to the next list's item, can reach the threshold.
                beyond = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    beyond = min(beyond, lists[pivot + 1][0][lists[pivot + 1][1]][0])
                target, moved = max(beyond, place + 1), lists[: pivot + 1]
            elif lists[0][0][lists[0][1]][0] == place:
                score = sum(x[0][x[1]][1] for x in lists[: pivot + 1])
                if score >= 1:
                    found.append((place, score))
                target, moved = place + 1, lists[: pivot + 1]
            else:
                target, moved = place, [x for x in lists[: pivot + 1] if x[0][x[1]][0] < place]
            for x in moved:
                posting, at = x[0], x[1]
                while at < len(posting) and posting[at][0] < target:
                    at += 1
                x[1] = at
            lists = [x for x in lists if x[1] < len(x[0])]
        return found

    def leaks(self, text: str | None) -> list[dict]:
        """Items that some passage of the text holds, each with its best passage."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        get = self.terms.get
        terms = np.array([get(w, -1) for w in words], dtype=np.int64)
        best: dict[int, tuple] = {}
        done: set[tuple[int, int]] = set()
        for block, j in self.passages(terms):
            step = int(self.step[block])
            span = (j * step, (j + 4) * step)
            if span in done:
                continue
            done.add(span)
            some = terms[span[0] : span[1]]
            retrieved = self.search(set(some[some >= 0].tolist()))
            if not retrieved:
                continue
            passage = words[span[0] : span[1]]
            held = {size: {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)} for size in range(1, WORDS + 1)}
            for place, score in retrieved:
                whole = self.whole[place]
                hits = sum(s in held[len(s)] for s in whole)
                if 100 * hits < self.percent * len(whole):
                    continue
                question, answer = (sum(s in held[len(s)] for s in p) / len(p) if p else 1.0 for p in self.parts[place])
                if place not in best or (question + answer, score) > best[place][:2]:
                    best[place] = (question + answer, score, question, answer)
        return [
            {"item_id": self.ids[place], "score": b[1], "question": b[2], "answer": b[3]} for place, b in sorted(best.items())
        ]


@lru_cache(maxsize=2)
def _index(items: tuple[tuple[int, str], ...], percent: int) -> Index:
    """One per worker and pass."""
    return Index(list(items), percent)


def contamination(
    docs: DataFrame, items: DataFrame, percent: int = 80, text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with ``leaks``: the benchmark items that each text holds.

    The items are indexed, the texts are the queries: passages twice as long as the items, overlapping so that
    every run of an item's length lies in one. A vectorized bound per block of items (the block's best weights
    of rare terms, plus all that common terms can give) rules out nearly all passages; block-max WAND retrieves
    every item above its threshold for the others, and the retrieved items are verified: at least ``percent``
    per cent of an item's distinct five-word shingles stand in the passage. The shares of the question's and the
    answer's shingles (the answer being the last sentence) are reported. The threshold follows from that
    percentage, so retrieval loses nothing that verification would keep.

    The index goes to the workers in passes of at most ``PASS_CHARS`` characters of items (or one longer item);
    a larger benchmark takes more passes over the texts. No shuffle.

    Words are runs of letters, digits and underscores, lowered. Null and empty texts hold nothing; items without
    words are held by nothing; items of fewer than five words count as one shingle. Repeated items are reported
    each; an item with a null id is reported with it. Columns of ``docs`` stay; those named ``leaks`` and
    ``found`` are replaced and dropped.
    """
    wanted = items.select(F.col(item_column).cast("long").alias("id"), F.col(item_text_column).alias("text")).where("text is not null")
    found = docs.drop("leaks")
    held: list[tuple[int, str]] = []
    chars = 0
    for row in wanted.orderBy(F.col("id").asc_nulls_first(), "text").toLocalIterator():
        if held and chars + len(row["text"]) > PASS_CHARS:
            # The driver holds the items of one pass only.
            found, held = staged(_pass(found, tuple(held), percent, text_column), "passes"), []
            chars = 0
        held.append((row["id"], row["text"]))
        chars += len(row["text"])
    return _pass(found, tuple(held), percent, text_column)


def _pass(docs: DataFrame, items: tuple[tuple[int, str], ...], percent: int, text_column: str) -> DataFrame:
    """One pass over the texts: adds what they hold of ``items`` to what they are known to hold."""

    def work(texts: list) -> dict[str, list]:
        index = _index(items, percent)
        return {"found": [index.leaks(text) for text in texts]}

    made = columns_added(docs, text_column, work, f"found {LEAKS}")
    if "leaks" in docs.columns:
        return made.withColumn("leaks", F.concat("leaks", "found")).drop("found")
    return made.withColumnRenamed("found", "leaks")
