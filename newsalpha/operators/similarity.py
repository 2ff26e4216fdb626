"""Cosine similarity of a whole vector table against a panel of vectors.

The panel (some sampled headlines, some query terms) is fetched in blocks, and every task
compares its own rows with a block in matrix products. Work grows with the table times the
panel, and no pairs of table rows are formed. A panel that equals the table gives the full
matrix of a small set.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsalpha.functions.vectors import combine
from newsalpha.session import stage

# Vectors of the panel that are compared in one pass, and cosines that are in memory at once.
PANEL_ROWS = 5_000
CELLS = 4_000_000


def panel_blocks(panel: DataFrame, key: str, vector: str, rows: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and unit vectors of a panel in blocks, in order of the ids; the driver holds one block."""
    held: list = []
    present = panel.where(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias(vector))
    kind = to_arrow_type(panel.schema[key].dataType)

    def block():
        return pa.array([row[key] for row in held], kind), unit_rows(pa.array([row[vector] for row in held], pa.list_(pa.float64())))

    for row in present.orderBy(key).toLocalIterator():
        held.append(row)
        if len(held) == rows:
            yield block()
            held = []
    if held:
        yield block()


def unit_rows(vectors: pa.ListArray) -> np.ndarray:
    """Rows of a list column as a matrix of unit vectors; a zero vector stays zero."""
    if len(vectors) == 0:
        return np.zeros((0, 0))
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths == 0, 1.0, lengths)


def compare(df: DataFrame, panel: DataFrame, key: str, vector: str, keep, block_rows: int = PANEL_ROWS) -> DataFrame:
    """(id, panel_id, cosine) rows that ``keep`` picks from each similarity matrix.

    ``keep`` gets a matrix (rows by panel) of at most ``CELLS`` cosines and the mask of different ids, and
    returns the row and panel positions to emit. A panel of several blocks takes a pass over the table for
    each; what all but the last pass find is written, so that no more than a block is held.
    """
    id_type = df.schema[key].dataType.simpleString()
    present = df.where(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias(vector))
    found: DataFrame | None = None
    for ids, targets in panel_blocks(panel, key, vector, block_rows):
        if found is not None:
            found = stage(found, "cosines")
        some = present.mapInArrow(_compared(ids, targets, key, vector, keep), f"{key} {id_type}, panel_id {id_type}, cosine double")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return df.sparkSession.createDataFrame([], f"{key} {id_type}, panel_id {id_type}, cosine double")
    return found


def _compared(ids: pa.Array, targets: np.ndarray, key: str, vector: str, keep):
    names = ids.to_numpy(zero_copy_only=False)
    step = max(1, CELLS // len(ids))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, step):
                piece = part.slice(start, step)
                cosine = np.clip(unit_rows(piece.column(vector)) @ targets.T, -1.0, 1.0)
                own = piece.column(key).to_numpy(zero_copy_only=False)
                rows, columns = keep(cosine, own[:, None] != names[None, :], own, names)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(key).take(pa.array(rows)), ids.take(pa.array(columns)), pa.array(cosine[rows, columns])],
                    names=[key, "panel_id", "cosine"],
                )

    return batches


def pairwise_cosine(df: DataFrame, panel: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Cosine of every row with every panel vector, to three decimals."""

    def everything(cosine, different, own, names):
        return (axis.ravel() for axis in np.indices(cosine.shape))

    pairs = compare(df, panel, key, vector, everything)
    return pairs.withColumn("cosine", F.round("cosine", 3))


def top_n_nearest(df: DataFrame, queries: DataFrame, key: str, vector: str = "embedding", n: int = 5) -> DataFrame:
    """The ``n`` most similar rows per query, the query terms themselves left out.

    Each batch sends on at most ``n`` rows per query; equal cosines go by id.
    """

    def best(cosine, different, own, names):
        usable = np.where(np.isin(own, names)[:, None], -np.inf, cosine)
        order = np.lexsort((np.broadcast_to(own[:, None], usable.shape), -usable), axis=0)[:n]
        columns = np.broadcast_to(np.arange(usable.shape[1]), order.shape)
        chosen = np.isfinite(usable[order, columns])
        return order[chosen], columns[chosen]

    ranked = Window.partitionBy("panel_id").orderBy(F.desc("cosine"), key)
    nearest = compare(df, queries, key, vector, best)
    return nearest.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)


def extreme_pairs(df: DataFrame, panel: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """The most and the least similar pair of different ids, one row each.

    A batch sends on its own two extremes; equal cosines go by ids. Each pair is
    written with the smaller id first.
    """

    def extremes(cosine, different, own, names):
        if not different.any():
            return np.array([], dtype=int), np.array([], dtype=int)
        picked = set()
        for sign in (1, -1):
            value = np.where(different, sign * cosine, -np.inf)
            # Close to the extreme is a tie, so that rounding settles nothing; the first pair by ids is taken.
            rows, columns = np.nonzero(value >= value.max() - 1e-12)
            low, high = np.minimum(own[rows], names[columns]), np.maximum(own[rows], names[columns])
            first = np.lexsort((high, low))[0]
            picked.add((int(rows[first]), int(columns[first])))
        return np.array(sorted(picked)).T

    pairs = compare(df, panel, key, vector, extremes).select(
        F.least(key, "panel_id").alias("id_a"), F.greatest(key, "panel_id").alias("id_b"), "cosine"
    )
    rounded = F.round("cosine", 9)
    first = pairs.agg(*(
        F.min(F.struct(order.alias("place"), "id_a", "id_b", "cosine", F.lit(which).alias("which"))).alias(which)
        for which, order in (("most", -rounded), ("least", rounded))
    ))
    return first.select(F.inline(F.array("most", "least"))).drop("place").where(F.col("which").isNotNull())


def vector_analogy(df: DataFrame, a, b, c, key: str, vector: str = "embedding", n: int = 5) -> DataFrame:
    """Rows nearest to ``a - b + c``, without the three terms."""
    terms = df.where(F.col(key).isin(a, b, c))

    def term(name):
        return F.first(F.when(F.col(key) == name, F.col(vector)), ignorenulls=True)

    target = terms.agg(term(a).alias("a"), term(b).alias("b"), term(c).alias("c")).select(
        F.lit(a).cast(df.schema[key].dataType).alias(key), combine(F.col("a"), F.col("b"), F.col("c")).alias(vector)
    )
    others = df.where(~F.col(key).isin(a, b, c))
    return top_n_nearest(others, target, key, vector, n).select(key, "cosine", "rank")
