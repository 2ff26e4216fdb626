"""Short codes of vectors: an index into a codebook per part, fitted with bounds that spare most distances."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import released, staged

# Entries of a part's list of closest ones in the first pass; later passes make the lists shorter, to a half at least.
LISTED = 8
# Of the rows of a batch, one in so many may need more than its list.
RARE = 64
# Components are below this, so that sums of squares stay exact in 64 bits.
LARGEST = 1 << 16
# Floating point errors of bounds are far below this share.
MARGIN = 1e-9

PASSED = "vec_id {id}, label {label}, whole binary, state binary, sums array<long>"
CODED = "vec_id {id}, label {label}, code binary, error long"


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to the entries of one codebook, or to those listed for each row."""
    return ((x[:, None, :] - entries) ** 2).sum(2)


def _below(x: np.ndarray) -> np.ndarray:
    """As 16-bit floating point numbers that are not larger."""
    short = np.minimum(x, 60_000).astype(np.float16)
    return np.where(short > x, np.nextafter(short, np.float16(0)), short)


def listed(x: np.ndarray, entries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``length`` closest entries of each row in order, lower bounds, and the exact distance of the first.

    Bound z is below the distance of the entry at place z + 1; the last is the outer bound, below that of all
    entries that are not listed. Of entries at equal distance the one with the lower index comes first.
    """
    far = squares(x, entries)
    order = np.argsort(far, axis=1, kind="stable")[:, : length + 1]
    roots = np.sqrt(np.take_along_axis(far, order, 1)[:, 1:])
    if roots.shape[1] < length:
        roots = np.pad(roots, ((0, 0), (0, length - roots.shape[1])), constant_values=np.inf)
    return order[:, :length], roots, np.take_along_axis(far, order[:, :1], 1)[:, 0]


def moved(x: np.ndarray, closest: np.ndarray, bounds: np.ndarray, entries: np.ndarray, shifts: np.ndarray) -> tuple:
    """Lists, bounds and distances after the entries have moved by ``shifts``; how many places of its list each row needed.

    Bounds shrink by the way their entries went, the outer one by the longest way, and are put in order from
    the outer one inwards. Entries from the first place on whose bound is above the distance of the present
    entry cannot be nearer; those before it are measured in integers and sorted anew. Where the outer bound fails,
    all entries are measured.
    """
    closest, bounds = closest.copy(), bounds.astype(np.float64)
    bounds[:, :-1] -= shifts[closest[:, 1:]]
    bounds[:, -1] -= shifts.max()
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1].copy()
    own = squares(x, entries[closest[:, :1]])[:, 0]
    depth = (bounds <= np.sqrt(own)[:, None] * (1 + MARGIN) + MARGIN).sum(1)
    for z in np.unique(depth).tolist():
        rows = np.flatnonzero(depth == z)
        if z == bounds.shape[1]:
            closest[rows], bounds[rows], own[rows] = listed(x[rows], entries, z)
        elif z:
            some = closest[rows, : z + 1]
            far = squares(x[rows], entries[some])
            order = np.lexsort((some, far), axis=1)
            far = np.take_along_axis(far, order, 1)
            closest[rows, : z + 1] = np.take_along_axis(some, order, 1)
            own[rows], bounds[rows, :z] = far[:, 0], np.sqrt(far[:, 1:])
    return closest, bounds, own, depth


def _cut(closest: np.ndarray, depth: np.ndarray, least: int) -> int:
    """How many entries to list from now on, given the places that the rows of a batch needed."""
    needed = np.quantile(depth, 1 - 1 / RARE, method="higher") + 2
    return int(np.clip(needed, min(least, closest.shape[1]), closest.shape[1]))


def _pack(lists: list[tuple[np.ndarray, np.ndarray]]) -> list[bytes]:
    """One string per row: the length of each part's list, then the lists and the bounds of all parts."""
    n = len(lists[0][0])
    lengths = np.tile(np.array([c.shape[1] for c, _ in lists], dtype=np.uint8), (n, 1))
    columns = [lengths, *(c.astype(np.uint8) for c, _ in lists)]
    columns += [_below(np.maximum(b, 0)).view(np.uint8).reshape(n, -1) for _, b in lists]
    return [row.tobytes() for row in np.concatenate(columns, axis=1)]


def _unpack(states: list[bytes], parts: int) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Rows whose lists have the same lengths, with their lists."""
    groups: dict[bytes, list[int]] = {}
    for i, state in enumerate(states):
        groups.setdefault(state[:parts], []).append(i)
    for head, places in groups.items():
        rows = np.frombuffer(b"".join(states[i] for i in places), dtype=np.uint8).reshape(len(places), -1)
        lengths, at, lists = list(head), parts, []
        for length in lengths:
            lists.append(rows[:, at : at + length].astype(np.int64))
            at += length
        bounds = []
        for length in lengths:
            bounds.append(np.ascontiguousarray(rows[:, at : at + 2 * length]).view(np.float16))
            at += 2 * length
        yield np.array(places), list(zip(lists, bounds))


class Totals:
    """Sums and numbers of the parts of each entry, and the distances measured, of one task."""

    def __init__(self, parts: int, entries: int, width: int):
        self.sums, self.measured = np.zeros((parts, entries, width + 1), dtype=np.int64), 0

    def add(self, part: int, x: np.ndarray, own: np.ndarray) -> None:
        entries = self.sums.shape[1]
        for place in range(x.shape[1]):
            # Sums of one batch are far below the limit of exact floating point numbers.
            self.sums[part, :, place] += np.bincount(own, weights=x[:, place], minlength=entries).astype(np.int64)
        self.sums[part, :, -1] += np.bincount(own, minlength=entries)

    def row(self) -> list[int]:
        return [*self.sums.ravel().tolist(), self.measured]


def _batch(fields: dict[str, pa.DataType], values: dict[str, object]) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values.values(), fields.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


def _passed(df: DataFrame, schema: str, start, parts: int, entries: int, width: int) -> DataFrame:
    """One pass over all rows: their new states, and one last row per task with its totals."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, fields = Totals(parts, entries, width), None
        for batch in batches:
            fields = {
                "vec_id": batch.schema.field("vec_id").type, "label": batch.schema.field("label").type,
                "whole": pa.binary(), "state": pa.binary(), "sums": pa.list_(pa.int64()),
            }
            whole, states = start(batch, totals)
            same = {"vec_id": batch.column("vec_id"), "label": batch.column("label")}
            yield _batch(fields, {**same, "whole": whole, "state": states, "sums": [None] * len(whole)})
        if fields:
            yield _batch(fields, {"vec_id": [None], "label": [None], "whole": [None], "state": [None], "sums": [totals.row()]})

    return staged(df.mapInArrow(work, schema), "codes")


def _integers(whole: list[bytes], parts: int) -> np.ndarray:
    """Rows, parts, places."""
    return np.frombuffer(b"".join(whole), dtype="<i4").reshape(len(whole), parts, -1).astype(np.int64)


def _totals(passed: DataFrame, shape: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Sums over all tasks; added up in the cluster, one number per component of an entry reaches the driver."""
    summed = passed.where("sums is not null").select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x"))
    found = np.array([r["x"] for r in sorted(summed.collect(), key=lambda r: r["place"])], dtype=np.int64)
    return found[:-1].reshape(shape), int(found[-1])


def _renewed(books: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of their parts' mean; those without parts stay."""
    counts = sums[:, :, -1:]
    return np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), books)


def fit_codes(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, listing: int = LISTED,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Codebooks of the parts of vectors, and the code of every vector.

    Components become floor(``scale`` * component). A part's codebook starts as that part of the vectors with the
    smallest ids; each round assigns every part to its nearest entry (ties: the lower index) and replaces the
    entries by the floor of the mean of their parts. The first pass measures all entries and keeps, per part, the
    ``listing`` closest ones in order with lower bounds of their distances and one outer bound for all others. A later
    pass shrinks the bounds by the way the entries moved and measures only what they leave open, in integers;
    where few rows of a batch need a whole list, the batch keeps shorter ones. A pass reads the rows and
    their states from the shared folder and writes both anew; sums of entries come with it, one row a task, so
    nothing is shuffled but those. A lost executor costs its tasks of one pass.

    Left out: null or empty vectors, those with a null or non-finite component or one of ``LARGEST`` or more in
    absolute value, and those whose length is no multiple of ``parts`` or not that of the vector with the smallest id. Null
    ids come last. Rows of one id count each; fewer vectors than entries give fewer entries. Other columns are
    ignored. Empty table: no rows, no entries.
    Returns the table ``vec_id, label, code`` (one byte per part) and ``error`` (squared distances of all parts), the
    codebooks as part x entry x place, and the number of distances measured in each pass (but the first: all).
    """
    source = df.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where(
        (F.size("vector") > 0) & (F.size("vector") % parts == 0)
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float(LARGEST)))
    )
    types = {"id": dict(source.dtypes)["vec_id"], "label": dict(source.dtypes)["label"]}
    ordered = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    first = source.orderBy(*ordered).limit(1).collect()
    if not first:
        return source.selectExpr("vec_id", "label", "cast(null as binary) as code", "0L as error"), np.zeros((parts, 0, 0), dtype=np.int64), []
    width = len(first[0]["vector"]) // parts
    source = source.where(F.size("vector") == parts * width)
    start = source.orderBy(*ordered).limit(entries).collect()
    books = np.floor(scale * np.array([row["vector"] for row in start])).astype(np.int64)
    books = books.reshape(len(start), parts, width).transpose(1, 0, 2)
    count, schema = books.shape[1], PASSED.format(**types)

    def begin(known: np.ndarray):
        def work(batch: pa.RecordBatch, totals: Totals) -> tuple[list[bytes], list[bytes]]:
            x = np.floor(scale * batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)).astype("<i4")
            whole, lists = [row.tobytes() for row in x], []
            x = x.astype(np.int64).reshape(len(x), parts, width)
            for part in range(parts):
                closest, bounds, _ = listed(x[:, part], known[part], min(listing, count))
                totals.add(part, x[:, part], closest[:, 0])
                lists.append((closest, bounds))
            return whole, _pack(lists)

        return work

    def go_on(known: np.ndarray, shifts: np.ndarray):
        def work(batch: pa.RecordBatch, totals: Totals) -> tuple[list[bytes], list[bytes]]:
            whole, states = batch.column("whole").to_pylist(), batch.column("state").to_pylist()
            x, made = _integers(whole, parts), [b""] * len(whole)
            for rows, lists in _unpack(states, parts):
                new = []
                for part, (closest, bounds) in enumerate(lists):
                    closest, bounds, _, depth = moved(x[rows, part], closest, bounds, known[part], shifts[part])
                    totals.add(part, x[rows, part], closest[:, 0])
                    totals.measured += int(np.where(depth == bounds.shape[1], count, depth + 1).sum())
                    length = _cut(closest, depth, max(2, listing // 2))
                    # What is cut off is behind the bound of its first place; bounds are put in order again before they are used.
                    outer = bounds[:, length - 1 :].min(1, keepdims=True)
                    new.append((closest[:, :length], np.concatenate([bounds[:, : length - 1], outer], axis=1)))
                for i, state in zip(rows.tolist(), _pack(new)):
                    made[i] = state
            return whole, made

        return work

    def finish(known: np.ndarray, shifts: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, states = _integers(batch.column("whole").to_pylist(), parts), batch.column("state").to_pylist()
                code, error = np.zeros((len(x), parts), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
                for rows, lists in _unpack(states, parts):
                    for part, (closest, bounds) in enumerate(lists):
                        closest, _, own, _ = moved(x[rows, part], closest, bounds, known[part], shifts[part])
                        code[rows, part] = closest[:, 0]
                        error[rows] += own
                fields = {"vec_id": batch.schema.field("vec_id").type, "label": batch.schema.field("label").type, "code": pa.binary(), "error": pa.int64()}
                yield _batch(fields, {
                    "vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": [row.tobytes() for row in code], "error": error,
                })

        return work

    passed = _passed(source, schema, begin(books), parts, count, width)
    measured, shifts = [], np.zeros((parts, count))
    for again in range(rounds):
        sums, done = _totals(passed, (parts, count, width + 1))
        measured.append(done)
        new = _renewed(books, sums)
        # Rounded up, as a bound may only become too low.
        shifts, books = np.sqrt(((new - books) ** 2).sum(2)) * (1 + MARGIN), new
        if again < rounds - 1:
            last, passed = passed, _passed(_states(passed), schema, go_on(books, shifts), parts, count, width)
            released(last)
    coded = staged(_states(passed).mapInArrow(finish(books, shifts), CODED.format(**types)), "coded")
    released(passed)
    return coded, books, measured[1:]


def _states(passed: DataFrame) -> DataFrame:
    return passed.where("whole is not null").select("vec_id", "label", "whole", "state")


def fingerprint(books: np.ndarray) -> str:
    """Digest of the components of all entries, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, **settings) -> DataFrame:
    """Codes of all vectors as hexadecimal digits, with errors by vector and by label: see ``fit_codes``.

    ``label_error`` sums the errors of equal labels, those of null labels together.
    Returns ``vec_id, label, code, error, label_error, codebooks_sha256``.
    """
    coded, books, _ = fit_codes(df, **settings)
    by_label = coded.groupBy(F.col("label").alias("its_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("its_label")), "left")
    return joined.select(
        "vec_id", "label", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )
