"""Near-duplicate vectors by an epsilon grid order join."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.llm.common import components, staged

# Leading principal dimensions of the grid.
LEADING = 6
# Bytes of the vectors of a block, the smallest interval that is shuffled.
BLOCK_BYTES = 1 << 20
# Vectors of the intervals at which the recursion ends inside a block.
LEAF = 256
# Children of an interval.
FAN = 8
# Rounding that distances and single-precision products may carry.
MARGIN = 1e-4

BLOCK = "dim int, number long, nodes binary, copies binary, vectors binary, low array<double>, high array<double>"


def near_vectors(
    df: DataFrame, least: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Groups of vectors whose cosine is at least ``least``.

    Equal vectors are one class first. Unit vectors are projected on their leading principal dimensions
    (fitted on all of them), cut into cells of the width of the largest linked distance, and sorted
    lexicographically by cell. The sequence is cut into blocks; intervals of blocks are joined with each
    other top down, and a pair of intervals whose bounding boxes are farther apart than that distance is
    not followed. What is left is pairs of blocks: they meet in one row each, the recursion goes on inside,
    and close leaves are compared in double precision. A pair of blocks returns the number of links of
    each vector and a spanning forest, never the links themselves, so crowded regions stay small.

    Null vectors, zero vectors and those with null or non-finite components link with nothing; vectors of
    different lengths do not link either. Rows with a null id link with nothing, get a null component and
    are kept. Repeated rows count as vectors of their own in ``n_links``. Other columns are ignored.
    Returns ``vec_id, n_links, component_id, kept``.
    """
    spark = df.sparkSession
    vector = F.col(vector_column)
    source = df.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).withColumn(
        "sound",
        F.coalesce(
            F.col("vec_id").isNotNull()
            & F.expr("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
            & F.expr("exists(vector, x -> x <> 0)"),
            F.lit(False),
        ),
    )
    same = ["h", "g"]
    hashed = source.select(
        "vec_id", "vector", "sound", F.xxhash64("vector").alias("h"), F.xxhash64(F.reverse("vector"), F.lit(1)).alias("g")
    )
    classes = staged(
        hashed.where("sound").groupBy(*same)
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    bases = {row["dim"]: _basis(classes, row["dim"]) for row in classes.select("dim").distinct().collect()}
    reach = float(np.sqrt(2 - 2 * least))
    blocks = _blocks(classes, bases, reach)
    met = _block_pairs(blocks, reach).select("x", "y")
    payload = blocks.select("number", "dim", "nodes", "copies", "vectors")
    both = met.join(payload.select(*(F.col(c).alias(f"{c}_x") for c in payload.columns)).withColumnRenamed("number_x", "x"), "x")
    both = both.join(payload.select(*(F.col(c).alias(f"{c}_y") for c in payload.columns)).withColumnRenamed("number_y", "y"), "y")
    double = dict(df.dtypes)[vector_column] == "array<double>"
    wanted = ["x", "y", "dim_x", "nodes_x", "copies_x", "vectors_x", "nodes_y", "copies_y", "vectors_y"]
    found = staged(
        both.where("dim_x = dim_y").select(*wanted).mapInArrow(_joiner(bases, least, reach, double), "node long, links long, root long"),
        "links",
    )
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b")), "roots")
    known = (
        classes.select(*same, "node", "copies").join(links, "node", "left").join(roots, "node", "left")
        .select(*same, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "node").alias("component"))
        .withColumn("sound", F.lit(True))
    )
    return hashed.drop("vector").join(known, [*same, "sound"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )


def _basis(classes: DataFrame, dim: int) -> np.ndarray:
    """Leading principal dimensions of the vectors of one length; columns are orthonormal."""
    some = classes.where(F.col("dim") == dim)
    wanted = min(LEADING, dim)
    if len(some.limit(2).take(2)) < 2:
        return np.eye(dim)[:, :wanted]
    scaled = F.expr("transform(vector, x -> x / array_max(transform(vector, y -> abs(y))))")
    unit = some.select(scaled.alias("v")).select(
        F.expr("transform(v, x -> x / sqrt(aggregate(v, 0d, (s, y) -> s + y * y)))").cast("array<double>").alias("v")
    )
    model = PCA(k=wanted, inputCol="f", outputCol="p").fit(unit.select(array_to_vector("v").alias("f")))
    basis, _ = np.linalg.qr(model.pc.toArray())
    return basis


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _place(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Coordinates in the leading dimensions, and the length of the rest: distances in them are never larger."""
    leading = unit @ basis
    rest = np.sqrt(np.maximum(0, 1 - (leading * leading).sum(1)))
    return np.hstack([leading, rest[:, None]])


def _blocks(classes: DataFrame, bases: dict[int, np.ndarray], reach: float) -> DataFrame:
    """The sequence in grid order, cut into blocks that are numbered in it."""
    array_type = dict(classes.dtypes)["vector"]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            cell = [np.floor(_place(_unit(np.array([v])), bases[len(v)])[0] / reach).astype(int).tolist() for v in vectors]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])

    order = ["dim", "cell", "node"]
    rows = classes.select("node", "copies", "dim", "vector").mapInArrow(
        cells, f"node long, copies long, dim int, vector {array_type}, cell array<int>"
    )
    kind = np.float64 if array_type == "array<double>" else np.float32

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "node", "copies", "vector"))):
                if held and (row[0] != held[0][0] or len(held) * held[0][0] * kind().itemsize >= BLOCK_BYTES):
                    yield block(held, number)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield block(held, number)

    def block(held: list[tuple], number: int) -> pa.RecordBatch:
        vectors = np.array([row[3] for row in held], dtype=kind)
        places = _place(_unit(vectors), bases[held[0][0]])
        values = (
            held[0][0], number, np.array([row[1] for row in held], dtype=np.int64).tobytes(),
            np.array([row[2] for row in held], dtype=np.int64).tobytes(), vectors.tobytes(),
            _padded(places.min(0)), _padded(places.max(0)),
        )
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[p.split()[0] for p in BLOCK.split(", ")])

    made = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCK).withColumn("part", F.spark_partition_id()),
        "blocks",
    )
    # One row per range: the places of ranges in the sequence.
    counts = made.groupBy("part").agg(F.count("*").alias("blocks"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("offset"))
    return made.join(F.broadcast(offsets), "part").withColumn("number", F.col("number") + F.col("offset")).drop("part", "offset")


def _padded(values: np.ndarray) -> list[float]:
    return np.concatenate([values, np.zeros(LEADING + 1 - len(values))]).tolist()


def _block_pairs(blocks: DataFrame, reach: float) -> DataFrame:
    """Pairs x <= y of blocks that may hold linked vectors, found top down over intervals of the sequence."""
    spark = blocks.sparkSession
    sides = range(LEADING + 1)
    boxes = blocks.select(
        "number", F.col("dim").alias("dim_low"), F.col("dim").alias("dim_high"),
        *(F.col("low")[i].alias(f"low{i}") for i in sides), *(F.col("high")[i].alias(f"high{i}") for i in sides),
    )
    count = blocks.count()
    height = 0
    while count > FAN ** (height + 1):
        height += 1
    pairs = spark.range(-(-count // FAN**height)).select(
        F.col("id").alias("x"), F.explode(F.expr(f"sequence(id, {max(0, -(-count // FAN**height) - 1)})")).alias("y")
    )
    for level in range(height, -1, -1):
        box = boxes.groupBy(F.expr(f"number div {FAN**level}").alias("number")).agg(
            *(F.min(c).alias(c) for c in boxes.columns if "low" in c), *(F.max(c).alias(c) for c in boxes.columns if "high" in c)
        )
        of_x = box.select(F.col("number").alias("x"), *(F.col(c).alias(f"x_{c}") for c in box.columns[1:]))
        of_y = box.select(F.col("number").alias("y"), *(F.col(c).alias(f"y_{c}") for c in box.columns[1:]))
        gaps = " + ".join(f"pow(greatest(0d, x_low{i} - y_high{i}, y_low{i} - x_high{i}), 2)" for i in sides)
        near = f"{gaps} <= {(reach + MARGIN) ** 2!r} and x_dim_low <= y_dim_high and y_dim_low <= x_dim_high"
        pairs = pairs.join(of_x, "x").join(of_y, "y").where(near).select("x", "y")
        if level:
            child = f"sequence({{0}} * {FAN}, least({{0}} * {FAN} + {FAN - 1}, {-(-count // FAN ** (level - 1)) - 1}))"
            pairs = (
                pairs.select(F.explode(F.expr(child.format("x"))).alias("x"), "y")
                .select("x", F.explode(F.expr(child.format("y"))).alias("y")).where("x <= y")
            )
    return pairs


def _joiner(bases: dict[int, np.ndarray], least: float, reach: float, double: bool):
    """Links of the vectors of two blocks: their number by vector, and a spanning forest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                yield _joined(row, bases[row["dim_x"]], least, reach, np.float64 if double else np.float32)

    return work


def _joined(row: dict, basis: np.ndarray, least: float, reach: float, kind) -> pa.RecordBatch:
    alone = row["x"] == row["y"]
    sides = []
    for side in "xy"[: 1 if alone else 2]:
        unit = _unit(np.frombuffer(row[f"vectors_{side}"], dtype=kind).reshape(-1, row["dim_x"]))
        place = _place(unit, basis)
        cuts = np.arange(0, len(unit), LEAF)
        sides.append((
            np.frombuffer(row[f"nodes_{side}"], dtype=np.int64), np.frombuffer(row[f"copies_{side}"], dtype=np.int64), unit,
            unit.astype(np.float32), np.minimum.reduceat(place, cuts), np.maximum.reduceat(place, cuts), np.zeros(len(unit), dtype=np.int64),
        ))
    first, second = sides[0], sides[-1]
    links: list[np.ndarray] = []
    gap = np.maximum(0, np.maximum(first[4][:, None] - second[5][None], second[4][None] - first[5][:, None]))
    close = (gap * gap).sum(2) <= (reach + MARGIN) ** 2
    for i, j in np.argwhere(close).tolist():
        if alone and j < i:
            continue
        a, b = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
        if (first[3][a] @ second[3][b].T).max() < least - MARGIN:
            continue
        hit = first[2][a] @ second[2][b].T >= least
        if alone and i == j:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        first[6][a] += hit @ second[1][b]
        if not (alone and i == j):
            second[6][b] += first[1][a] @ hit
        links.append(_forest(hit, first[0][a], second[0][b]))
    edges = _spanned(np.vstack(links)) if links else np.empty((0, 2), dtype=np.int64)
    nodes = np.concatenate([s[0] for s in sides])
    counts = np.concatenate([s[6] for s in sides])
    some = counts > 0
    none = pa.nulls(int(some.sum()), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([pa.array(nodes[some]), pa.array(edges[:, 0])]),
        pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(edges), pa.int64())]),
        pa.concat_arrays([none, pa.array(edges[:, 1])]),
    ], names=["node", "links", "root"])


def _forest(hit: np.ndarray, nodes_a: np.ndarray, nodes_b: np.ndarray) -> np.ndarray:
    """Edges that connect what the links of two leaves connect: each node with the least it reaches."""
    high = np.iinfo(np.int64).max
    a, b = nodes_a.copy(), nodes_b.copy()
    while True:
        to_a = np.minimum(a, np.where(hit, b[None, :], high).min(1))
        to_b = np.minimum(b, np.where(hit, to_a[:, None], high).min(0))
        if (to_a == a).all() and (to_b == b).all():
            break
        a, b = to_a, to_b
    nodes, roots = np.concatenate([nodes_a, nodes_b]), np.concatenate([a, b])
    return np.column_stack([nodes, roots])[nodes != roots]


def _spanned(edges: np.ndarray) -> np.ndarray:
    """Each node of the edges with the least node of its component."""
    nodes, at = np.unique(edges, return_inverse=True)
    at = at.reshape(-1, 2)
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[at[:, 0]], label[at[:, 1]])
        np.minimum.at(label, at[:, 0], low)
        np.minimum.at(label, at[:, 1], low)
        label = label[label]
        if (label == before).all():
            break
    kept = label != np.arange(len(nodes))
    return np.column_stack([nodes[kept], nodes[label[kept]]])
