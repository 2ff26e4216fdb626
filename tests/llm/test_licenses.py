import random
import re

from newsalpha.llm import licenses

from .conftest import ROWS

NOTICES = (*licenses.NOTICES, ("one", "single"), ("alpha beta beta gamma delta epsilon zeta eta theta iota kappa", "greek"))
PHRASES = (*licenses.PHRASES, ("beta beta", "twice"))


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered)


def brute(text, percent, notices=NOTICES, phrases=PHRASES):
    """Every block against every notice, every place against every phrase."""
    words, places, blocks = words_of(text), [], []
    for phrase, label in phrases:
        p = words_of(phrase)
        places += [(label, i) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    for notice, label in notices:
        n, step = words_of(notice), 1
        while step < len(n):
            step *= 2
        for start in range(0, len(words), step):
            share = len(set(words[start : start + 2 * step]) & set(n)) / len(set(n))
            if share * 100 >= percent - 1e-9:
                blocks.append((label, start, min(len(words), start + 2 * step), share))
    return len(words), sorted(places), sorted(blocks)


def found(row):
    return row.n_words, sorted((p.label, p.start) for p in row.phrases), sorted((b.label, b.start, b.end, b.share) for b in row.notices)


def test_equals_all_blocks(frame):
    rng = random.Random(2)
    vocabulary = [w.decode() for w in licenses.vocabulary(NOTICES, PHRASES)] + ["ähnlich", "wort", "x1", "日本語"]
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 20, 90]))))
            notice = rng.choice([t for t, _ in (*NOTICES, *PHRASES)]).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                notice[rng.randrange(len(notice))] = rng.choice(vocabulary)
            parts.append(rng.choice([" ", "\n", " - "]).join(notice))
        texts.append((rng.choice(["\n", ". ", "\t"])).join(parts).upper() if rng.random() < 0.2 else "\n".join(parts))
    df = frame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for percent in (60, 90, 100):
        rows = sorted(licenses.licenses(df, NOTICES, PHRASES, percent).collect(), key=lambda r: r.doc_id)
        assert [found(r) for r in rows] == [brute(t, percent) for t in texts]
    assert sum(len(r.notices) for r in rows) > 100 and sum(len(r.phrases) for r in rows) > 100


def test_a_notice_is_found_wherever_it_stands(frame):
    """Whatever words stand before it, however it is broken into lines, and as often as it is there."""
    rows = []
    for notice, label in licenses.NOTICES:
        rows += [(label, "wort " * before + "\n".join(notice.split()) + " wort" * 50) for before in range(0, 70, 7)]
    found_ = licenses.licenses(frame(rows, "label string, text string"), keep=["label"]).collect()
    assert len(found_) == len(rows)
    assert all(any(b.label == r.label and b.share == 1.0 for b in r.notices) for r in found_)


def test_common_words_are_no_license(frame):
    text = "The source of this software may be under the version of a permission that is free. " * 30
    row = licenses.summary(licenses.licenses(frame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_base, row.labels, row.score) == (0, "", 0.0)


def test_summary(frame):
    text = "x Apache License, y. Licensed under the MIT License. z CC BY-NC"
    row = licenses.summary(licenses.licenses(frame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (13, 3, 1, 10)
    assert (row.base_labels, row.labels, row.score) == ("apache,cc-by,mit", "apache,cc-by,mit", 1.0)
    row = licenses.summary(licenses.licenses(frame([(1, "SPDX-License-Identifier: MIT")], "doc_id long, text string"))).first()
    assert (row.n_base, row.first_word, row.base_labels, row.labels, row.score) == (0, None, "", "mit", 1.0)


def test_long_words_and_parts(monkeypatch):
    monkeypatch.setattr(licenses, "PART", 7)
    text = "under the MIT-License " + "y" * 50 + " a, b"
    assert [w for part in licenses.words_of(text) for w in part] == [w.encode() for w in words_of(text)]


def test_odd_rows(odd):
    rows = licenses.licenses(odd, NOTICES, PHRASES).collect()
    expected = sorted((brute(r[1], 90) for r in ROWS), key=str)
    assert sorted((found(r) for r in rows), key=str) == expected
    assert {r.path for r in rows} == {"own path"}


def test_empty(empty):
    assert licenses.licenses(empty).collect() == []
