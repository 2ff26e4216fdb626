import random
import re

from pyspark.sql import functions as F

from newsalpha.llm import lines as steps
from newsalpha.llm.common import DROPS_SHUFFLES
from newsalpha.llm.lines import deduplicate_lines

from .conftest import ROWS


def brute(docs, percent=80):
    """Texts without lines that an earlier line matches."""
    earlier, made = [], []
    for text in docs:
        kept = []
        for line in text.split("\n"):
            words = set(line.lower().split())
            match = words and any(100 * len(words & e) >= percent * len(words | e) for e in earlier)
            if words:
                earlier.append(words)
            if not match:
                kept.append(line)
        made.append("\n".join(kept))
    return made


def test_equals_all_pairs(frame):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 5, 9, 14, 30]))) for _ in range(150)]
    for _ in range(200):
        line = rng.choice(lines).split()
        line[rng.randrange(len(line))] = rng.choice(words)
        rng.shuffle(line)
        lines.append(" ".join(line + [rng.choice(words)] * rng.randint(0, 1)).upper() if rng.random() < 0.2 else " ".join(line))
    docs = ["\n".join(rng.choice([*lines, "", "  "]) for _ in range(rng.randint(1, 6))) for _ in range(150)]
    rows = deduplicate_lines(frame(list(enumerate(docs)), "doc_id long, text string").repartition(4)).orderBy("doc_id").collect()
    expected = brute(docs)
    assert [r.text for r in rows] == expected
    assert [r.n_lines for r in rows] == [d.count("\n") + 1 for d in docs]
    assert sum(r.n_removed for r in rows) > 100


def test_odd_rows(odd):
    rows = deduplicate_lines(odd).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by_id[None].text == ROWS[0][1]
    assert (by_id[1].text, by_id[1].n_lines, by_id[1].n_removed) == (None, 0, 0)
    assert by_id[2].text == "" and by_id[3].text == ROWS[3][1] and by_id[4].text == ROWS[4][1]
    assert by_id[6].text == ROWS[6][1] and by_id[7].text == "" and [r.text for r in rows if r.doc_id == 7] == ["", ""]
    assert by_id[8].text == "ein Satz für alle\n" and by_id[8].n_removed == 2
    assert by_id[5].row == "own row" and by_id[5].first == "own first"


def test_empty(empty):
    assert deduplicate_lines(empty).collect() == []


def test_only_built_in_expressions(odd):
    plan = deduplicate_lines(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pairs_of_a_group_of_variants_are_not_listed(frame):
    """Twice the variants of one line leave about twice the pairs for the full join, not four times as many."""
    rng = random.Random(5)
    words = [f"v{int(rng.paretovariate(0.8)) % 5000}" for _ in range(20_000)]
    base, left = rng.sample(sorted(set(words)), 70), []
    for n in (300, 600):
        docs = []
        for i in range(n):
            line = list(base)
            for _ in range(rng.randint(1, 6)):
                line[rng.randrange(70)] = rng.choice(words)
            docs.append((i, " ".join(line)))
        rows = frame(docs, "doc long, text string").select("doc", F.xxhash64("text").alias("version"), "text").repartition(4)
        rarity = steps._rarity(rows)
        classes = steps.staged(steps._classes(rows, rarity, 80), "lines")
        likely = steps._first_candidates(classes, 80)
        settled = steps._verified(likely, steps._sets_of(likely, classes, rows, rarity), 80).select(F.col("b_id").alias("id"), F.lit(True).alias("settled"))
        flagged = classes.join(settled, "id", "left").fillna(False, ["settled"])
        left.append(steps._candidates(flagged, 80).count())
        assert likely.count() <= 8 * n
    assert left[1] <= 2 * n, left


def test_words_end_at_any_white_space(frame):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["a", "Bc", "é", " ", "  ", "\t", "\n", "\x0b", "\f", "\r", "\u00a0", "\u2003"][: rng.choice([5, 12])]) for _ in range(30)) for _ in range(300)]
    rows = frame([(t,) for t in texts], "text string").select("text", F.array_remove(steps._words(F.col("text")), "").alias("words"))
    for row in rows.collect():
        assert row.words == [w for w in re.split(r"[ \t\n\x0b\f\r]+", row.text.lower()) if w], row.text


def test_steps_leave_no_shuffle_files(spark, frame):
    """The files of a shuffle go with the end of its step, not when the driver's cleaner happens to come round to them."""
    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", held.mkString(" ")))

    docs = frame([(i, f"one line of text {i % 7} number\nanother line {i}") for i in range(200)], "doc_id long, text string")
    before, setting = files(), spark.conf.get(DROPS_SHUFFLES)
    cleaned = deduplicate_lines(docs)
    assert not files() - before
    assert spark.conf.get(DROPS_SHUFFLES) == setting
    assert cleaned.count() == 200
