"""Byte-level BPE by segment trees over the byte positions of pre-tokens, and back."""

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from newsalpha.llm.common import columns_added

# No pair stands here, or it is not in the vocabulary.
NONE = np.int64(1) << 60
# Entries of the table of known pre-tokens in a worker; two generations are kept.
KNOWN = 250_000
# Positions of all trees that are worked on at once.
CELLS = 1 << 17
# Fewer trees of one width than this are worked on one by one.
FEW = 48
# Longer pre-tokens are, too.
WIDE = 256


class Splitter:
    """Cuts texts into pre-tokens.

    The pattern's letter and number classes are slow to test. Texts that stay below U+0250 use the same
    pattern with both classes written out as character ranges; all others use the pattern itself.
    """

    LIMIT = 0x250

    def __init__(self, pattern: str):
        import regex

        self.any = regex.compile(pattern)
        classes = {kind: self._class(kind) for kind in "LN"}
        spaces = "".join(map(re.escape, "\t\n\v\f\r \x85\xa0"))
        few = pattern.replace(r"\p{L}", classes["L"]).replace(r"\p{N}", classes["N"])
        few = few.replace(r"[^\s", f"[^{spaces}").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]")
        few = re.sub(r"(?<!\[\^)" + re.escape(classes["L"]) + r"\+", lambda m: f"[{classes['L']}]+", few, count=1)
        few = re.sub(r"(?<!\[\^)(?<! \?\[)" + re.escape(" ?" + classes["N"]) + r"\+", lambda m: f" ?[{classes['N']}]+", few, count=1)
        self.few = re.compile(few)
        self.beyond = re.compile(f"[^\x00-{chr(self.LIMIT - 1)}]")

    def _class(self, kind: str) -> str:
        inside = [i for i in range(self.LIMIT) if unicodedata.category(chr(i))[0] == kind]
        spans, start = [], None
        for i, char in enumerate(inside):
            start = char if start is None else start
            if i + 1 == len(inside) or inside[i + 1] != char + 1:
                spans.append(re.escape(chr(start)) + ("-" + re.escape(chr(char)) if char > start else ""))
                start = None
        return "".join(spans)

    def split(self, text: str) -> list[str]:
        return (self.few if text.isascii() or not self.beyond.search(text) else self.any).findall(text)

    def finder(self, text: str):
        return self.few if text.isascii() or not self.beyond.search(text) else self.any


class Vocabulary:
    """Ranks of byte strings, and of the pairs of ids that merge into them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.shift = np.int64(max(self.bytes_of) + 2)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * int(self.shift) + right] = rank
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], dtype=np.int64)
        # Ranks of the pairs of two bytes, where every pre-token starts.
        self.first = self.rank(*(x.ravel() for x in np.meshgrid(self.single, self.single, indexing="ij"))).reshape(256, 256)
        self.spelled = {i: str(i) for i in self.bytes_of}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge. Negative ids stand for no neighbour."""
        wanted = left * self.shift + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where((self.pairs[at] == wanted) & (left >= 0) & (right >= 0), self.merged[at], NONE)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of every pre-token. Pre-tokens of similar length share one stack of segment trees."""
        found: list[list[int]] = [[]] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = [whole]
            elif piece:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            if len(members) < FEW or width > WIDE:
                for i in members:
                    found[i] = self._merge_one(pieces[i], width)
                continue
            step = max(1, CELLS // width)
            for start in range(0, len(members), step):
                some = members[start : start + step]
                for i, ids in zip(some, self._merge([pieces[i] for i in some], width)):
                    found[i] = ids
        return found

    def _merge(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Merge pairs until none is left.

        A leaf of a tree holds rank * width + position of the pair that starts there, so that the root
        is the leftmost pair of the lowest rank. A merge writes three leaves (the pair's own, that of the
        part it swallowed and that of the live neighbour before it) and their ancestors. All arrays are
        flat: a row of ``span`` = width + 1 places per pre-token, the last one standing for its end.
        """
        count, span = len(pieces), width + 1
        raw = np.frombuffer(b"".join([p.ljust(span, b"\0") for p in pieces]), dtype=np.uint8).reshape(count, span)
        inside = np.arange(span) < np.array([len(p) for p in pieces])[:, None]
        ids = np.where(inside, self.single[raw], -1).ravel()
        own = np.arange(span)
        after = np.tile(np.minimum(own + 1, width), count)
        before = np.tile(np.where(own < width, own - 1, width - 1), count)
        tree = np.full((count, 2 * width), NONE)
        rank = self.first[raw[:, :-1], raw[:, 1:]]
        tree[:, width:] = np.where(inside[:, 1:] & (rank < NONE), rank * width + own[:-1], NONE)
        level = width
        while level > 1:
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, level // 2 : level])
            level //= 2
        tree = tree.ravel()
        live = np.flatnonzero(tree[1 :: 2 * width] < NONE)
        while len(live):
            top, row = live * (2 * width), live * span
            best = tree.take(top + 1)
            merged, left = np.divmod(best, width)
            right = after.take(row + left)
            beyond = after.take(row + right)
            ids[row + left] = merged
            ids[row + right] = -1
            after[row + left] = beyond
            before[row + beyond] = left
            tree[top + (width + right)] = NONE
            self._lift(tree, top, right + width)
            self._put(tree, top, left, merged, ids.take(row + beyond), width)
            earlier = before.take(row + left)
            some = np.flatnonzero(earlier >= 0)
            if len(some):
                at = earlier[some]
                self._put(tree, top[some], at, ids.take(row[some] + at), merged[some], width)
            live = live[tree.take(top + 1) < NONE]
        kept = ids >= 0
        ends = np.cumsum(kept.reshape(count, span).sum(1)).tolist()
        flat = ids[kept].tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_one(self, piece: bytes, width: int) -> list[int]:
        """The same for a single pre-token, however long."""
        none, ranks, spell = int(NONE), self.ranks, self.bytes_of
        ids = [self.ranks[piece[i : i + 1]] for i in range(len(piece))]
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        tree = [none] * (2 * width)

        def put(at: int) -> None:
            rank = ranks.get(spell[ids[at]] + spell[ids[after[at]]]) if after[at] < size else None
            tree[width + at] = none if rank is None else rank * width + at

        def lift(at: int) -> None:
            node = (width + at) >> 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b
                node >>= 1

        for at in range(size):
            put(at)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, left = divmod(tree[1], width)
            right = after[left]
            ids[left], ids[right] = rank, -1
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
            tree[width + right] = none
            put(left)
            lift(right)
            lift(left)
            if before[left] >= 0:
                put(before[left])
                lift(before[left])
        return [i for i in ids if i >= 0]

    def _put(self, tree, top, at, left, right, width) -> None:
        rank = self.rank(left, right)
        tree[top + (width + at)] = np.where(rank < NONE, rank * width + at, NONE)
        self._lift(tree, top, at + width)

    @staticmethod
    def _lift(tree, top, node) -> None:
        node = node >> 1
        while node[0]:
            here = top + node
            below = here + node
            tree[here] = np.minimum(tree.take(below), tree.take(below + 1))
            node = node >> 1

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


class Encoder:
    """Encodes texts; remembers pre-tokens it has seen, up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.words, self.splitter = Vocabulary(path), Splitter(pattern)
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    def learn(self, pieces: set[str]) -> dict[str, tuple[str, int, bytes]]:
        """Ids as text, number of ids and decoded bytes of each pre-token."""
        if len(self.known) > KNOWN:
            self.known, self.older = {}, self.known
        known = self.known
        missing, spelled = [], self.words.spelled
        for piece in pieces:
            if piece not in known:
                kept = self.older.get(piece)
                if kept is None:
                    missing.append(piece)
                else:
                    known[piece] = kept
        for piece, ids in zip(missing, self.words.encode([p.encode() for p in missing])):
            known[piece] = (",".join([spelled[i] for i in ids]), len(ids), self.words.decode(ids))
        return known

    def entries(self, texts: list[str]) -> Iterator[list[tuple[str, int, bytes]]]:
        """Entries of the pre-tokens of each text; the new pre-tokens of all texts are learned at once."""
        split = [self.splitter.split(text) for text in texts]
        known = self.learn(set(chain.from_iterable(split)))
        for pieces in split:
            yield [known[p] for p in pieces]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker and vocabulary."""
    return Encoder(path, pattern)


def public_tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path of a vocabulary file and the pattern of its pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode(
    df: DataFrame, path: str, pattern: str, output: str = "ids", text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Encode whole texts and decode the ids again.

    ``path`` names a file of ranks that every worker can read. Each match of ``pattern`` is encoded by
    itself: a segment tree over its bytes keeps the leftmost pair of lowest rank at the root. The trees
    of all new pre-tokens of a text are worked on together as arrays; known ones are looked up, and that
    table is bounded. No shuffle: tasks are the splits of the scan.

    Null text counts as empty: no ids, empty bytes. Repeated rows give repeated rows. Returns the columns in
    ``keep`` (all by default) and, for ``output="ids"``, ``ids`` (array<int>) and ``decoded`` (binary); for
    ``output="digests"``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256``.
    Input columns of these names are replaced.
    """
    if output not in ("ids", "digests"):
        raise ValueError(f"output is ids or digests, not {output}")
    def work(texts: list) -> dict[str, list]:
        coder = encoder(path, pattern)
        made: dict[str, list] = {name: [] for name in names}
        for entries in coder.entries([text or "" for text in texts]):
            decoded = b"".join([e[2] for e in entries])
            ids = ",".join([e[0] for e in entries])
            if output == "ids":
                made["ids"].append([int(i) for i in ids.split(",")] if ids else [])
                made["decoded"].append(decoded)
            else:
                made["n_tokens"].append(sum([e[1] for e in entries]))
                made["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                made["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
        return made

    names = ("ids", "decoded") if output == "ids" else ("n_tokens", "ids_sha256", "decoded_sha256")
    types = "ids array<int>, decoded binary" if output == "ids" else "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return columns_added(df, text_column, work, types, keep)
