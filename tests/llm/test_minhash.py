import random
import re

from newsalpha.llm import shingles
from newsalpha.llm.minhash import near_duplicates

from .conftest import ROWS

LOWER = {i: i + 32 for i in range(65, 91)}


def sets(texts, words):
    made = []
    for text in texts:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        size = min(words, len(found))
        made.append({tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set())
    return made


def groups(ids, found, percent):
    label = list(range(len(ids)))
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if found[i] and found[j]
             and 100 * len(found[i] & found[j]) >= percent * len(found[i] | found[j])]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j], key=lambda k: ids[k])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return [ids[k] for k in label], len(pairs)


def test_words_do_not_depend_on_the_parts_a_text_is_read_in(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abÄ \n\x0bZé" + "x" * 20) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    whole = [shingles.word_hashes(text).tolist() for text in texts]
    assert [len(w) for w in whole] == [len(re.findall(r"[^\x20\x09-\x0D]+", text)) for text in texts]
    monkeypatch.setattr(shingles, "PART", 16)
    monkeypatch.setattr(shingles, "_tables", [])
    assert [shingles.word_hashes(text).tolist() for text in texts] == whole


def test_groups_of_all_pairs(frame):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 6, 30, 120]))) for _ in range(120)]
    for _ in range(280):
        words = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append("  ".join(words).title())
    ids = rng.sample(range(10_000), len(texts))
    rows = near_duplicates(frame(list(zip(ids, texts)), "doc_id long, text string").repartition(5), words=4).collect()
    found = sets(texts, 4)
    expected, links = groups(ids, found, 80)
    got = {r.doc_id: r for r in rows}
    assert [got[i].n_shingles for i in ids] == [len(s) for s in found]
    # The forest may miss a pair; among these hundreds of links it misses none.
    assert links > 200 and [got[i].component_id for i in ids] == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_recall_at_the_threshold(frame):
    rng = random.Random(12)
    texts = []
    for n in range(300):
        base = [f"{n}x{i}" for i in range(104)]
        twin = list(base)
        # 100 to 101 shingles of four words; changing words at the end spoils few of them.
        twin[-10:] = [f"{n}y{i}" for i in range(10)]
        texts += [" ".join(base), " ".join(twin)]
    found = sets(texts, 4)
    alike = [n for n in range(300) if 100 * len(found[2 * n] & found[2 * n + 1]) >= 80 * len(found[2 * n] | found[2 * n + 1])]
    rows = {r.doc_id: r.component_id for r in near_duplicates(frame(list(enumerate(texts)), "doc_id long, text string"), words=4).collect()}
    hits = sum(rows[2 * n + 1] == 2 * n for n in alike)
    assert len(alike) == 300 and hits >= 0.99 * len(alike)


def test_one_large_group(frame):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(400):
        words = list(base)
        words[rng.randrange(200)] = f"x{rng.random()}"
        texts.append(" ".join(words))
    rows = near_duplicates(frame(list(enumerate(texts)), "doc_id long, text string"), words=4).collect()
    assert {r.component_id for r in rows} == {0}


def test_a_late_original_meets_all_of_its_variants(frame):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for n in range(300):
        words = list(base)
        start = rng.randrange(270)
        words[start : start + 27] = [f"{n}x{i}" for i in range(27)]  # 0.82 like the original, 0.68 like one another
        texts.append(" ".join(words))
    texts.append(" ".join(base))
    expected, links = groups(list(range(301)), sets(texts, 4), 80)
    rows = {r.doc_id: r for r in near_duplicates(frame(list(enumerate(texts)), "doc_id long, text string"), words=4).collect()}
    assert links >= 300 and set(expected) == {0} and [rows[i].component_id for i in range(301)] == expected


def test_linked_pairs_of_one_template(frame):
    rng = random.Random(8)
    template = [f"t{i}" for i in range(150)]
    texts = []
    for n in range(150):
        own = [f"{n}o{i}" for i in range(42)]
        twin = own[:28] + [f"{n}p{i}" for i in range(14)]
        texts += [" ".join(template + own), " ".join(template + twin)]
    ids = rng.sample(range(10_000), len(texts))
    expected, links = groups(ids, sets(texts, 4), 80)
    rows = {r.doc_id: r for r in near_duplicates(frame(list(zip(ids, texts)), "doc_id long, text string"), words=4).collect()}
    assert links == 150 and [rows[i].component_id for i in ids] == expected


def test_odd_rows(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and all(by_id[i].kept for i in (1, 2, 3))
    assert by_id[7].component_id == 6 and not by_id[7].kept and by_id[6].kept
    assert by_id[None].component_id is None and by_id[None].kept and by_id[None].n_shingles == 4
    assert near_duplicates(empty).collect() == []
