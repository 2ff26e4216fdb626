"""Secrets in texts: fixed patterns, and strings that zstandard cannot shorten."""

import re
from bisect import bisect_left, bisect_right

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import rows_mapped, staged

# The patterns of the base kinds, in the order of the kinds, and the shortest match that counts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "novel")

# Words that make their surroundings sensitive; a keyword of ASSIGN contains one of the first four.
SENSITIVE = ("passw", "secret", "token", "key", "credential", "bearer", "auth", "private", "pwd", "login")
# A candidate for the novelty test, and how far behind a sensitive word it may start beyond the word's scope.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
REACH = 64
# Characters before a candidate that it is measured against.
CONTEXT = 256
# Characters that two strings in sensitive places have in common if one is known from the other.
PIECE = 8

SPAN = "struct<kind: string, start: int, end: int, text: string>"
FOUND = f"doc_id {{kind}}, base array<{SPAN}>, candidates array<struct<start: int, end: int, before: string, text: string>>"

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(r"[0-9a-f]{24,}")  # a run of HEX is always matched whole
_blank = re.compile(r"\n[^\S\n]*\n")
_break = re.compile(r"\n")
_bracket = re.compile(r"[()\[\]{}]")
_joint = re.compile(r"[\W_]*")
_PAIRS = {")": "(", "]": "[", "}": "{"}
_sensitive = re.compile("|".join(SENSITIVE))


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Leftmost matches of each base kind that are long enough, by start, then kind."""
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    found = []
    if any(word in lower for word in SENSITIVE[:4]):
        found += [("assign", *m.span(), m[0]) for m in _assign.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in _access.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span(), m[0]) for m in _hex.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_LOWER = {i: i + 32 for i in range(65, 91)}


def scopes(text: str, ends: list[int]) -> list[int]:
    """How far the scope of the sensitive word that ends at each of ``ends`` goes.

    That is to the end of its block of lines, which a blank line ends, of the brackets around it, and of the
    brackets that open behind it in its line; ``REACH`` characters at least. Brackets without a partner are no scope.
    """
    blanks = [m.start() for m in _blank.finditer(text)]
    breaks = [m.start() for m in _break.finditer(text)]
    pairs, stack, waiting = [], [], dict.fromkeys(_PAIRS.values(), 0)
    for m in _bracket.finditer(text):
        if m[0] not in _PAIRS:
            stack.append((m[0], m.start()))
            waiting[m[0]] += 1
        elif waiting[_PAIRS[m[0]]]:
            opening = None
            while opening != _PAIRS[m[0]]:
                opening, start = stack.pop()
                waiting[opening] -= 1
            pairs.append((start, m.start()))
    pairs.sort()
    # The farthest end of the brackets that open from each one on in its line.
    lines = [bisect_left(breaks, start) for start, _ in pairs]
    farthest = [end for _, end in pairs]
    for i in range(len(pairs) - 2, -1, -1):
        if lines[i] == lines[i + 1]:
            farthest[i] = max(farthest[i], farthest[i + 1])
    made, at, around = [], 0, []
    for end in ends:
        while at < len(pairs) and pairs[at][0] < end:
            while around and around[-1] < pairs[at][0]:
                around.pop()
            around.append(pairs[at][1])
            at += 1
        while around and around[-1] < end:
            around.pop()
        place = bisect_left(blanks, end)
        reach = max(end + REACH, blanks[place] if place < len(blanks) else len(text), around[-1] if around else 0)
        if at < len(pairs) and lines[at] == bisect_left(breaks, end):
            reach = max(reach, farthest[at])
        made.append(reach)
    return made


def _before(text: str, start: int, end: int, earlier: list[tuple[int, int]]) -> str:
    """The text before a string without the earlier strings in sensitive places that share no piece with it.

    Random strings have an alphabet in common, which must not make them vouch for one another.
    """
    at = max(0, start - CONTEXT)
    pieces = {text[i : i + PIECE] for i in range(start, end - PIECE + 1)}
    near = []
    for a, b in reversed(earlier):
        if b <= at:
            break
        near.append((max(a, at), b))
    parts = []
    for a, b in reversed(near):
        if not any(text[i : i + PIECE] in pieces for i in range(a, b - PIECE + 1)):
            parts.append(text[at:a])
            at = b
    return "".join([*parts, text[at:start]])


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str, str]]:
    """Unbroken strings in sensitive places that no base span touches, with the text before them.

    A string is in a sensitive place if it holds a sensitive word, stands behind one in its scope, or follows
    a string in a sensitive place with nothing but signs and white space between, as the lines of a key do.
    """
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    if not any(word in lower for word in SENSITIVE):
        return []
    strings = [m.span() for m in CANDIDATE.finditer(text)]
    if not strings:
        return []
    ends = [m.end() for m in _sensitive.finditer(lower)]
    limits = scopes(text, ends)
    for i in range(1, len(limits)):
        limits[i] = max(limits[i], limits[i - 1])
    taken: list[tuple[int, int]] = []
    for _, a, b, _ in base:
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    made, earlier = [], []
    last = None
    for start, end in strings:
        word = bisect_right(ends, start)
        joined = last is not None and _joint.fullmatch(text, last, start) is not None
        inside = word < len(ends) and ends[word] <= end
        if not (joined or inside or word and start <= limits[word - 1]):
            last = None
            continue
        last = end
        near = bisect_left(taken, (end,)) - 1
        if near < 0 or taken[near][1] <= start:
            made.append((start, end, _before(text, start, end, earlier), text[start:end]))
        earlier.append((start, end))
    return made


class Novelty:
    """Bytes that a string adds to a compressed context, with a dictionary of identifiers at hand."""

    def __init__(self, words: list[str], level: int):
        # Frequent words last: near matches are the cheapest.
        self.dictionary = zstandard.ZstdCompressionDict(
            " ".join(reversed(words)).encode() or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.dictionary.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(dict_data=self.dictionary, write_content_size=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode()))

    def share(self, before: str, text: str) -> float:
        return (self.size(before + text) - self.size(before)) / len(text.encode())


def identifiers(found: DataFrame, words: int) -> list[str]:
    """The ``words`` words that stand in most of the contexts of all candidates, most frequent first.

    Each distinct context counts once, so copies of a document do not make their own secrets frequent,
    and a word counts from its third context on. Words are letters and underscores only.
    """
    contexts = found.select(F.explode("candidates").alias("c")).select(F.concat_ws(" ", "c.before", "c.text").alias("context"))
    counted = (
        contexts.distinct()
        .select(F.explode(F.array_distinct(F.expr("regexp_extract_all(context, '[A-Za-z_]{3,}', 0)"))).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n")).where("n >= 3 and length(word) <= 64")
    )
    return [row["word"] for row in counted.orderBy(F.desc("n"), "word").limit(words).collect()]


def secrets(
    df: DataFrame, words: int = 4096, share: float = 0.8, level: int = 9, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Secrets of every whole text: the base kinds, and incompressible strings in sensitive places.

    A candidate is an unbroken string of 16 or more characters that holds a sensitive word, stands behind one
    in its line, block or brackets, or follows such a string. Its novelty is the number of bytes by which it lengthens the compressed text
    before it, where the compressor knows a dictionary of identifiers; from ``share`` of its own bytes on,
    it is reported as ``novel``. The dictionary is made of the ``words`` most frequent words of the
    contexts in the whole table, so its size has a bound and goes into the task closure. Texts are read once;
    what is found in them is written to the shared folder, and the second pass reads only that.

    Null text counts as empty. Repeated rows give repeated rows. Other columns are ignored.
    Returns ``doc_id`` and ``spans``, an array of kind, start, end (code points, end exclusive) and text,
    by start, then kind as listed in ``KINDS``.
    """
    kind = dict(df.dtypes)[id_column]

    def scan(columns: dict[str, list]) -> dict[str, list]:
        texts = [text or "" for text in columns["text"]]
        base = [base_spans(text) for text in texts]
        struct = [[dict(zip(("kind", "start", "end", "text"), s)) for s in spans] for spans in base]
        open_ = [[dict(zip(("start", "end", "before", "text"), c)) for c in candidates(t, b)] for t, b in zip(texts, base)]
        return {"doc_id": columns["doc_id"], "base": struct, "candidates": open_}

    source = df.selectExpr(f"`{id_column}` as doc_id", f"`{text_column}` as text")
    found = staged(rows_mapped(source, scan, FOUND.format(kind=kind)), "secrets")
    known = identifiers(found, words)

    def measure(columns: dict[str, list]) -> dict[str, list]:
        novelty = Novelty(known, level)
        spans = []
        for base, some in zip(columns["base"], columns["candidates"]):
            novel = [
                {"kind": "novel", "start": c["start"], "end": c["end"], "text": c["text"]}
                for c in some if novelty.share(c["before"], c["text"]) >= share
            ]
            spans.append(sorted([*base, *novel], key=lambda s: (s["start"], KINDS.index(s["kind"]))))
        return {"doc_id": columns["doc_id"], "spans": spans}

    return rows_mapped(found, measure, f"doc_id {kind}, spans array<{SPAN}>")
