"""Language of texts: the family first, then one-versus-one linear support vector machines within it."""

import re
import unicodedata
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.llm.common import columns_added, rows_mapped

# Hashed counts of the one to three letters that follow each other.
BUCKETS = 1 << 12
# Bytes of a text that are counted at once.
PART = 1 << 20
UNDETERMINED = "und"

# Families of languages by code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
}

# Letters, and signs of numbers such as fractions, which are told apart by their category.
_letter = re.compile(r"[^\W\d_]")
# ASCII letters are lowered, all other ASCII becomes a space.
_plain = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(unicodedata.category(m[0])[0] == "L" for m in _letter.finditer(text))


def profile(text: str) -> np.ndarray:
    """Unit vector of the square roots of the counts of hashed byte 1- to 3-grams; runs of other signs are one space."""
    counts = np.zeros(BUCKETS)
    raw = b" " + text.lower().encode().translate(_plain) + b" "
    for start in range(0, len(raw), PART):
        part = np.frombuffer(raw, dtype=np.uint8, count=min(PART, len(raw) - start), offset=start).astype(np.uint32)
        part = part[np.concatenate([[True], (part[1:] != 32) | (part[:-1] != 32)])]
        pairs = part[:-1] | part[1:] << np.uint32(8)
        for grams in (part, pairs | np.uint32(1 << 24), pairs[:-1] | part[2:] << np.uint32(16) | np.uint32(2 << 24)):
            slots = grams * np.uint32(2654435761) >> np.uint32(32 - 12)
            counts += np.bincount(slots, minlength=BUCKETS)
    vector = np.sqrt(counts)
    return vector / np.linalg.norm(vector)


def fit_margin(x: np.ndarray, rows: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 30) -> np.ndarray:
    """Linear support vector machine with squared hinge loss on some rows of ``x``, by coordinate descent on the dual.

    Rows are unit vectors; a constant 1 is their last component. ``y`` is 1 or -1 for each of ``rows``. Nothing is copied.
    """
    weights, bias, alpha = np.zeros(x.shape[1], dtype=x.dtype), 0.0, [0.0] * len(rows)
    diagonal = 2 + 0.5 / cost
    order, signs, places = np.random.default_rng(7), y.tolist(), rows.tolist()
    for _ in range(rounds):
        for i in order.permutation(len(places)).tolist():
            own = x[places[i]]
            gradient = signs[i] * (float(own @ weights) + bias) - 1 + alpha[i] * 0.5 / cost
            new = max(0.0, alpha[i] - gradient / diagonal)
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights += x.dtype.type(step) * own
                bias += step
                alpha[i] = new
    return np.append(weights, x.dtype.type(bias))


def _slope(margins: np.ndarray) -> float:
    """Scale that makes the logistic function of the signed margins most likely."""
    scales = np.geomspace(0.25, 32, 29)
    return float(scales[np.argmin([np.logaddexp(0, -s * margins).sum() for s in scales])])


class Duels:
    """One-versus-one machines over some classes; most wins decide, then the weakest win, then the name."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None):
        """``labels`` of all rows of ``x``, of which ``rows`` teach (all by default)."""
        rows = np.arange(len(x)) if rows is None else rows
        own = labels[rows]
        self.classes = sorted(set(own.tolist()))
        self.pairs, weights, slopes = list(combinations(range(len(self.classes)), 2)), [], []
        for i, j in self.pairs:
            some = rows[(own == self.classes[i]) | (own == self.classes[j])]
            y = np.where(labels[some] == self.classes[i], 1.0, -1.0)
            w = fit_margin(x, some, y)
            margins = np.array([float(x[k] @ w[:-1]) for k in some.tolist()]) + float(w[-1])
            weights.append(w)
            slopes.append(_slope(y * margins))
        self.weights, self.slopes = np.array(weights), np.array(slopes)

    def decide(self, x: np.ndarray) -> tuple[str, float]:
        if not self.pairs:
            return self.classes[0], 1.0
        chance = 1 / (1 + np.exp(-self.slopes * (self.weights[:, :-1] @ x + self.weights[:, -1])))
        wins, weakest = [0] * len(self.classes), [1.0] * len(self.classes)
        for (i, j), p in zip(self.pairs, chance.tolist()):
            wins[i if p >= 0.5 else j] += 1
            weakest[i], weakest[j] = min(weakest[i], p), min(weakest[j], 1 - p)
        best = max(range(len(wins)), key=lambda c: (wins[c], weakest[c], -c))
        return self.classes[best], max(weakest[best], 0.0)


class Hierarchy:
    """Machines between families, and within each family between its languages."""

    def __init__(self, x: np.ndarray, languages: np.ndarray, families: dict[str, tuple[str, ...]]):
        family_of = {language: family for family, members in families.items() for language in members}
        family = np.array([family_of.get(language, language) for language in languages.tolist()])
        self.families = Duels(x, family)
        self.languages = {name: Duels(x, languages, np.flatnonzero(family == name)) for name in self.families.classes}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not has_letter(text):
            return UNDETERMINED, 0.0
        x = profile(text)
        family, p = self.families.decide(x)
        language, q = self.languages[family].decide(x)
        return language, p * q


def fit(
    labelled: DataFrame, sample: int = 2000, classes: int = 100, families: dict[str, tuple[str, ...]] = FAMILIES,
    id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
) -> Hierarchy | None:
    """Fit on at most ``sample`` labelled rows, the same number of each language, drawn by a hash of id and text.

    The ``classes`` languages with most rows teach (ties: by code), so that a column of stray values makes neither a
    large plan nor many machines. Rows without language, text or letters are left out. The rows are chosen and profiled
    in the cluster; only the slots that a text fills reach the driver, some kilobytes a row of the bounded sample. None
    if nothing is left to learn from.
    """
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).cast("string").alias("language")
    ).where(F.col("language").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counted = rows.groupBy("language").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language").limit(classes)
    teaching = [row["language"] for row in counted.collect()]
    if not teaching:
        return None
    each = max(1, sample // len(teaching))
    drawn = Window.partitionBy("language").orderBy("draw")
    rows = rows.where(F.col("language").isin(teaching)).withColumn("draw", F.xxhash64("id", "text"))
    # The draws alone are ranked first, so that texts move only if they are in the sample.
    last = rows.select("language", "draw", F.row_number().over(drawn).alias("n")).where(F.col("n") <= each).groupBy("language").agg(F.max("draw").alias("last"))
    few = reduce(or_, ((F.col("language") == r["language"]) & (F.col("draw") <= r["last"]) for r in last.collect()))
    chosen = rows.where(few).withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= each).drop("n", "id", "draw")

    def profiles(columns: dict[str, list]) -> dict[str, list]:
        some = [i for i, text in enumerate(columns["text"]) if has_letter(text)]
        found = [profile(columns["text"][i]) for i in some]
        filled = [np.flatnonzero(p) for p in found]
        return {
            "language": [columns["language"][i] for i in some],
            "slots": [f.astype("<u2").tobytes() for f in filled],
            "sizes": [p[f].astype("<f4").tobytes() for p, f in zip(found, filled)],
        }

    found = rows_mapped(chosen, profiles, "language string, slots binary, sizes binary").orderBy("language", "slots", "sizes").toArrow()
    if not found.num_rows:
        return None
    x = np.zeros((found.num_rows, BUCKETS), dtype=np.float32)
    for row, slots, sizes in zip(x, found.column("slots").to_pylist(), found.column("sizes").to_pylist()):
        row[np.frombuffer(slots, "<u2")] = np.frombuffer(sizes, "<f4")
    return Hierarchy(x, np.array(found.column("language").to_pylist(), dtype=object), families)


def identify(
    df: DataFrame, model: Hierarchy | None, text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add the language of every whole text, and a score between 0 and 1.

    The score is the chance of the family times that of the language within it, each that of the weakest
    duel the winner was in. Null texts, texts without a letter, and all texts when there is no model are
    ``und`` with score 0. One pass without a shuffle; the model has a fixed size per pair of languages.
    Repeated rows give repeated rows. Returns the columns in ``keep`` (all by default) and ``lang_pred,
    score``; input columns of these two names are replaced.
    """

    def work(texts: list) -> dict[str, list]:
        found = [model.predict(text) if model else (UNDETERMINED, 0.0) for text in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return columns_added(df, text_column, work, "lang_pred string, score double", keep)


def held_out(id_column: str = "doc_id"):
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
