from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsalpha.llm.language import Duels, fit, held_out, identify, profile

from .conftest import ROWS

FOLDER = Path("/root/testdata/sf0.01")


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_accuracy_on_rows_nothing_is_learned_from(spark):
    docs = spark.read.parquet(str(FOLDER / "documents.parquet"))
    model = fit(docs.where(~held_out()))
    assert set(model.families.classes) == {"germanic", "romance"}
    found = identify(docs.where(held_out()), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.98 and 0 <= right[1] <= right[2] <= 1


def test_more_than_two_classes_meet_in_duels():
    import numpy as np

    texts = {"x": "aaa bab aab", "y": "ccc cdc ddc", "z": "eee fef ffe"}
    x = np.array([profile(t + f" {n}") for t in texts.values() for n in "gh"])
    duels = Duels(x, np.array([k for k in texts for _ in "gh"], dtype=object))
    assert [duels.decide(profile(t))[0] for t in texts.values()] == list(texts)


def test_odd_rows(odd, empty):
    model = fit(odd)
    assert set(model.languages) == {"germanic", "romance"}
    rows = identify(odd, model).collect()
    assert len(rows) == len(ROWS)
    undetermined = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert undetermined == {1, 2, 3, 9} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.row for r in rows} == {"own row"}
    assert fit(empty) is None and identify(empty, None).collect() == []
    assert {r.lang_pred for r in identify(odd, None).collect()} == {"und"}


def test_signs_of_numbers_are_no_letters(frame):
    texts = ["½ ²", "①②", "Ⅷ", "٣", "_ 12", "½ ª", "① é"]
    rows = identify(frame([(t,) for t in texts], "text string"), fit(frame([(1, "ein Wort", "de")], "doc_id long, text string, lang string"))).collect()
    assert [r.lang_pred for r in rows] == ["und"] * 5 + ["de"] * 2


def test_stray_labels_do_not_teach(frame):
    """The languages with most rows teach; of equal ones the first."""
    rows = [(i, f"ein Text mit Wort {i}", "de") for i in range(5)] + [(9, "one more text here", "en"), (10, "texte", "fr")]
    rows += [(100 + i, f"stray {i}", f"zz{i:03}") for i in range(150)]
    model = fit(frame(rows, "doc_id long, text string, lang string"), classes=2)
    assert [d.classes for d in model.languages.values()] == [["de", "en"]]


def test_machines_separate_what_can_be_separated():
    """The fit equals a plain gradient descent on the same objective."""
    import numpy as np

    from newsalpha.llm.language import fit_margin

    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=40) > 0, 1.0, -1.0)
    found = fit_margin(x, np.arange(40), y, cost=4.0, rounds=400)
    whole, w = np.hstack([x, np.ones((40, 1))]), np.zeros(6)
    for _ in range(20_000):
        short = np.maximum(0, 1 - y * (whole @ w))
        w -= 0.002 * (w - 2 * 4.0 * (whole * (y * short)[:, None]).sum(0))
    assert np.allclose(found, w, atol=1e-3)
