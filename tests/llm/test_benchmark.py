import random

from newsalpha.llm import benchmark
from newsalpha.llm.benchmark import Index, contamination, words_of

from .conftest import ROWS


def drawn(rng, n):
    return " ".join(f"w{rng.randrange(rng.choice([9, 800]))}" for _ in range(n))


def shares(item, text):
    def runs(words):
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    wanted, words = runs(words_of(item)), words_of(text)
    held = {tuple(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}
    return 100 * len(wanted & held) >= 80 * len(wanted) if wanted else False


def test_search_finds_all_above_the_threshold():
    rng = random.Random(3)
    index = Index([(i, drawn(rng, rng.randint(1, 40))) for i in range(300)], 80)
    for _ in range(300):
        terms = {index.terms[w] for w in words_of(drawn(rng, 60)) if w in index.terms}
        scores: dict[int, float] = {}
        for t in terms:
            for place, w in index.postings[t]:
                scores[place] = scores.get(place, 0) + w
        assert sorted(p for p, _ in index.search(terms)) == sorted(p for p, s in scores.items() if s >= 1)


def test_equals_a_comparison_of_every_text_with_every_item(frame, monkeypatch):
    rng = random.Random(8)
    items = [(i, drawn(rng, rng.choice([3, 5, 8, 20, 45, 90])) + ". " + drawn(rng, 6) + ".") for i in range(120)]
    texts = []
    for _ in range(150):
        words = drawn(rng, rng.randint(0, 400)).split()
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1].upper().split()
            if rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        texts.append(" ".join(words))
    expected = {(d, i) for d, text in enumerate(texts) for i, item in items if shares(item, text)}
    docs, table = frame(list(enumerate(texts)), "doc_id long, text string"), frame(items, "item_id long, text string")
    for most in (benchmark.PASS_CHARS, 9_000):
        monkeypatch.setattr(benchmark, "PASS_CHARS", most)
        rows = contamination(docs, table).collect()
        assert {(r.doc_id, leak.item_id) for r in rows for leak in r.leaks} == expected
    assert len(expected) > 50


def test_odd_rows(odd, empty, frame):
    items = frame([(1, "one text that stands here. More than once!"), (None, "of some words"), (2, None), (3, ""), (3, "?!"), (4, "end"), (None, "unseen"), (None, "unseen")], "item_id long, text string")
    rows = contamination(odd, items).collect()
    assert len(rows) == len(ROWS)
    found = {r.doc_id: [leak.item_id for leak in r.leaks] for r in rows}
    assert {i: f for i, f in found.items() if f} == {None: [None], 4: [4], 6: [1], 7: [1], 8: [1]}
    assert {r.row for r in rows} == {"own row"}
    assert contamination(empty, items).collect() == []
    assert all(r.leaks == [] for r in contamination(odd, items.limit(0)).collect())
