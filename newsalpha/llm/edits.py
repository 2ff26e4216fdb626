"""Token counts that follow edits: a segment tree over the pre-tokens of each document."""

from itertools import accumulate, chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.bpe import Encoder, encoder
from newsalpha.llm.common import columns_added

# Characters beyond its end that decide where a pre-token ends: the pattern looks at most this far.
LOOK = 4

EDIT = "struct<start: int, end: int, text: string>"
COUNTS = "n_tokens long, n_pieces long, n_tokens_before long, n_edits long, n_recounted long"
PIECES = "piece_chars array<int>, piece_tokens array<int>"


class CountTree:
    """Characters and tokens of the pre-tokens of a text, summed up in a segment tree.

    A leaf holds one pre-token at first. An edit hands all new pre-tokens of its region to the region's first
    leaf and empties the others, so that the tree keeps its shape and an edit costs the logarithm of its size
    for each leaf it touches.
    """

    def __init__(self, text: str, coder: Encoder, pieces: list[str] | None = None, known: dict | None = None):
        """``pieces`` and what is ``known`` of them, where the text has been split already."""
        self.text, self.coder = text, coder
        pieces = coder.splitter.split(text) if pieces is None else pieces
        known = coder.learn(set(pieces)) if known is None else known
        self.count = self.leaves = len(pieces)
        self.size = 1 << max(0, len(pieces) - 1).bit_length()
        # Leaves that an edit has touched; all others hold one piece, which their sums tell.
        self.touched: dict[int, list[tuple[int, int]]] = {}
        self.chars = self._summed([len(p) for p in pieces])
        self.tokens = self._summed([known[p][1] for p in pieces])

    def _summed(self, values: list[int]) -> np.ndarray:
        """The tree over some values, level by level from the leaves."""
        tree = np.zeros(2 * self.size, dtype=np.int64)
        tree[self.size : self.size + len(values)] = values
        low = self.size
        while low > 1:
            tree[low // 2 : low] = tree[low : 2 * low : 2] + tree[low + 1 : 2 * low : 2]
            low //= 2
        return tree

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place``, and where it starts; the last leaf beyond the end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        leaf = min(node - self.size, max(0, self.leaves - 1))
        return (leaf, start) if leaf == node - self.size else (leaf, start - self._chars(leaf))

    def _chars(self, leaf: int) -> int:
        return int(self.chars[self.size + leaf])

    def _held(self, leaf: int) -> list[tuple[int, int]]:
        held = self.touched.get(leaf)
        return [(self._chars(leaf), int(self.tokens[self.size + leaf]))] if held is None else held

    def _put(self, leaf: int, pieces: list[tuple[int, int]]) -> None:
        self.count += len(pieces) - len(self._held(leaf))
        self.touched[leaf] = pieces
        node = self.size + leaf
        chars, tokens = sum(p[0] for p in pieces) - self.chars[node], sum(p[1] for p in pieces) - self.tokens[node]
        while node and (chars or tokens):
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, start: int, end: int, text: str) -> int:
        """Replace the characters from ``start`` to before ``end``; returns the number of pre-tokens encoded anew."""
        if not self.leaves:
            self.__init__(text, self.coder)
            return self.count
        first, begin = self.leaf_at(max(0, start - LOOK))
        while first and begin > max(0, start - LOOK):
            first -= 1
            begin -= self._chars(first)
        new = self.text[:start] + text + self.text[end:]
        shift, changed = len(text) - (end - start), start + len(text)
        # Ends of the old leaves behind the edit, in places of the new text.
        last, old_end = first, begin + self._chars(first)
        spans, at = [], begin
        for m in self.coder.splitter.finder(new).finditer(new, begin):
            spans.append(m[0])
            at = m.end()
            if at >= changed:
                while old_end < end or old_end + shift < at:
                    if last + 1 == self.leaves:
                        break
                    last += 1
                    old_end += self._chars(last)
                if old_end >= end and old_end + shift == at:
                    break
        else:
            last = self.leaves - 1
        known = self.coder.learn(set(spans))
        self._put(first, [(len(p), known[p][1]) for p in spans])
        for leaf in range(first + 1, last + 1):
            if self._held(leaf):
                self._put(leaf, [])
        self.text = new
        return len(spans)

    def pieces(self) -> list[tuple[int, int]]:
        return [piece for leaf in range(self.leaves) for piece in self._held(leaf)]


def settle(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits of a text from its end to its start: places beyond the text are moved to its end, an end before its
    start to that start, and an edit that overlaps a later one is cut short there."""
    found = []
    for e in edits or []:
        if e is not None:
            start = min(max(0, e["start"] or 0), length)
            found.append((start, min(max(start, start if e["end"] is None else e["end"]), length), e["text"] or ""))
    starts = sorted(found, key=lambda e: e[:2])
    nexts = [*list(accumulate(reversed([s[0] for s in starts]), min))[::-1][1:], length]
    return [(start, min(end, after), text) for (start, end, text), after in zip(starts, nexts)][::-1]


def count_edited(
    df: DataFrame, edits: Column, path: str, pattern: str, text_column: str = "text", keep: list[str] | None = None,
    leaves: bool = True,
) -> DataFrame:
    """Token counts of whole texts before and after edits, without counting the whole text again.

    ``edits`` is an array of ``struct<start, end, text>`` per row: code points of the original text, end
    exclusive, and what stands there instead. The pre-tokens of a text are the leaves of a segment tree of
    characters and tokens. An edit finds its first leaf by descent, starts at the last boundary that the edit
    cannot move, re-encodes until a new boundary meets an old one behind the edit, and corrects the sums above
    the leaves it touched. Edits are applied from the end of the text to its start.

    Null texts count as empty, null edits as none; nulls inside an edit are 0 for the start, the start for the
    end, and no text. Out of range places are moved into the text; overlapping edits are cut at the next start.
    Repeated rows give repeated rows. Returns the columns in ``keep`` (all by default) and ``n_tokens, n_pieces``
    (after the edits), ``n_tokens_before, n_edits, n_recounted`` (pre-tokens encoded anew) and, if ``leaves``, the
    characters and tokens of the pre-tokens as ``piece_chars, piece_tokens``; input columns of these names are replaced.
    """

    def work(rows: list) -> dict[str, list]:
        coder = encoder(path, pattern)
        split = [coder.splitter.split(row["text"] or "") for row in rows]
        known = coder.learn(set(chain.from_iterable(split)))
        made: dict[str, list] = {part.split()[0]: [] for part in schema.split(", ")}
        for row, pieces in zip(rows, split):
            tree = CountTree(row["text"] or "", coder, pieces, known)
            before, todo = tree.total, settle(row["edits"], len(row["text"] or ""))
            recounted = sum(tree.edit(*edit) for edit in todo)
            values = [tree.total, tree.count, before, len(todo), recounted]
            if leaves:
                pieces = tree.pieces()
                values += [[p[0] for p in pieces], [p[1] for p in pieces]]
            for column, value in zip(made.values(), values):
                column.append(value)
        return made

    schema = f"{COUNTS}, {PIECES}" if leaves else COUNTS
    both = "__edited"
    source = df.withColumn(both, F.struct(F.col(text_column).alias("text"), edits.cast(f"array<{EDIT}>").alias("edits")))
    return columns_added(source, both, work, schema, df.columns if keep is None else keep)


def sample_edits(text_column: str = "text", id_column: str = "doc_id") -> Column:
    """Three edits per text, derived from its id: an insertion, a deletion and a replacement in its three thirds.

    New text is taken from the text itself, so that it looks like it.
    """
    text, size = F.coalesce(F.col(text_column), F.lit("")), F.length(F.coalesce(F.col(text_column), F.lit("")))

    def draw(name: str, below: Column | int) -> Column:
        value = F.crc32(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(name)))
        return (value % F.greatest(F.lit(1), F.lit(below) if isinstance(below, int) else below)).cast("int")

    third = (size / 3).cast("int")
    insert, remove, change = draw("insert", third), third + draw("remove", third), third * 2 + draw("change", third)
    some = F.substring(text, draw("from", size) + 1, draw("length", 24) + 1)
    return F.when(
        size > 0,
        F.array(
            F.struct(insert.alias("start"), insert.alias("end"), some.alias("text")),
            F.struct(remove.alias("start"), (remove + draw("removed", 40)).alias("end"), F.lit("").alias("text")),
            F.struct(change.alias("start"), (change + draw("changed", 16)).alias("end"), some.alias("text")),
        ),
    )
