import random
import re
import zlib
from collections import Counter

import numpy as np

from newsalpha.llm import spellings

from .conftest import ROWS


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    found = {}
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        found[w] = (n, len(near[w]), forms[w], words[forms[w]] if forms[w] else None, root)
    return found


def as_dict(rows):
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_all_pairs(frame):
    rng = random.Random(3)
    letters = "abcdé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(120)]
    docs = []
    for doc in range(400):
        words = []
        for _ in range(60):
            word = stems[min(int(rng.paretovariate(0.7)), 119)]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(word))
                word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        docs.append((doc if doc % 50 else None, rng.choice([" ", "-", "1\n"]).join(words)))
    found = as_dict(spellings.variants(frame(docs, "doc_id long, text string").repartition(5)).collect())
    assert found == brute(docs)
    assert sum(v[2] is not None for v in found.values()) > 50
    assert any(v[4] not in (w, v[2]) for w, v in found.items())


def test_neighbourhoods_are_whole():
    """Any two words one edit apart meet by their numbers, on the one side or the other, over two symbols as over eight."""
    rng = random.Random(5)
    for symbols in (1, 2, 8):
        words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(150)})
        number = [int(spellings.spelled(row[None])[0]) for row in spellings.reduced(words, symbols)]
        near = [set(np.concatenate([a.ravel() for a in spellings.neighbourhood(row[None], symbols)]).tolist()) for row in spellings.reduced(words, symbols)]
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                if one_edit(a, b):
                    assert number[j] in near[i] or number[i] in near[j]


def test_odd_rows(odd):
    assert as_dict(spellings.variants(odd).collect()) == brute([r[:2] for r in ROWS])


def test_very_long_words(frame):
    """Runs of many thousand letters are words; a step of forms may lead over several roots."""
    long = "abcdefgh" * 5000
    docs = [(i, f"{long} {long[:-1]}") for i in range(3)]
    assert as_dict(spellings.variants(frame(docs, "doc_id long, text string"), slips=False).collect()) == {
        long: (3, 1, None, None, long), long[:-1]: (3, 1, None, None, long[:-1])
    }


def test_roots_at_the_end_of_several_steps(frame):
    text = " ".join(["lettered"] * 1 + ["letteredx"] * 10 + ["letteredxy"] * 100 + ["letteredxyz"] * 1000)
    found = as_dict(spellings.variants(frame([(1, text), (2, "lettered")], "doc_id long, text string"), slips=False, least_count=1, ratio=5).collect())
    assert {v[4] for v in found.values()} == {"letteredxyz"} and found["lettered"][:4] == (2, 1, "letteredx", 10)


def test_empty(empty):
    assert spellings.variants(empty).collect() == []
