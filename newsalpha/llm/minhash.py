"""Near-duplicate texts by an LSH forest of MinHash signatures and an exact join for what it leaves apart."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.llm.common import components, released, rows_mapped, staged
from newsalpha.llm.shingles import links, mix, shingle_set

# Trees of the forest and values in a tree's order.
TREES = 10
DEPTH = 8
# Candidates share at least this many leading values in some tree.
LEAST_DEPTH = 2
# Neighbours on either side that a row is compared with in each tree.
WIDTH = 3
# Share of equal signature values, in per cent below the wanted similarity, that is worth a full check.
SLACK = 25
# Counters of the rarity of shingles, a multiple of the counters in a pack.
COUNTERS = 1 << 20
PACK = 1 << 12

ROWS = "tree int, key binary, node long"
FOREST = "a long, b long, edge int, tree int, key binary, node long"


def _factors() -> tuple[np.ndarray, np.ndarray]:
    drawn = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return drawn[: TREES * DEPTH], drawn[TREES * DEPTH :] | np.uint64(1)


def signature(shingles: np.ndarray) -> bytes:
    """The least value of the set under each of TREES * DEPTH hashes, 4 bytes each, in big-endian order."""
    masks, factors = _factors()
    least = np.full(len(masks), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None]
        least = np.minimum(least, ((part ^ masks) * factors).min(axis=0))
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def agreement(a: bytes, b: bytes) -> float:
    return float(np.mean(np.frombuffer(a, ">u4") == np.frombuffer(b, ">u4")))


def neighbours(width: int, least_depth: int):
    """Candidate pairs from the rows of one range of the sorted orders.

    Rows come sorted by tree and key. Each is paired with the up to ``width`` rows before it that share
    the longest prefixes with it, as long as a prefix has ``least_depth`` values: where many rows are alike
    this stops deep in the tree, elsewhere it reaches up to the least depth. Rows of one whole key are
    also paired with the first of them, however many there are. The first and last ``width`` rows are
    sent on as well, for pairs across ranges.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple[int, bytes, int]] = []
        seen, first = 0, None
        for batch in batches:
            made: dict[str, list] = {name: [] for name in ("a", "b", "edge", "tree", "key", "node")}

            def put(*values) -> None:
                for column, value in zip(made.values(), values):
                    column.append(value)

            for row in zip(*(batch.column(name).to_pylist() for name in ("tree", "key", "node"))):
                tree, key, node = row
                if seen < width:
                    put(None, None, 0, *row)
                for other in reversed(last):
                    if other[0] != tree or other[1][: 4 * least_depth] != key[: 4 * least_depth]:
                        break
                    put(min(other[2], node), max(other[2], node), None, None, None, None)
                if first is None or first[:2] != row[:2]:
                    first = row
                elif first not in last:
                    put(min(first[2], node), max(first[2], node), None, None, None, None)
                last = [*last, row][-width:]
                seen += 1
            yield _forest_batch(made)
        if seen > width:
            tail = last[-min(width, seen - width) :]
            yield _forest_batch({
                "a": [None] * len(tail), "b": [None] * len(tail), "edge": [1] * len(tail),
                "tree": [r[0] for r in tail], "key": [r[1] for r in tail], "node": [r[2] for r in tail],
            })

    return work


def _forest_batch(made: dict[str, list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), types)], names=list(made))


def candidates(signatures: DataFrame, width: int = WIDTH, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """Pairs ``a < b`` of nodes that are neighbours in some tree. ``signatures`` has ``node, signature``."""
    size = 4 * DEPTH
    rows = signatures.select(
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "node", "signature"
    ).select("tree", F.expr(f"substring(signature, tree * {size} + 1, {size})").alias("key"), "node")
    order = ["tree", "key", "node"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = staged(
        ranges.mapInArrow(neighbours(width, least_depth), FOREST).withColumn("part", F.spark_partition_id()), "forest"
    )
    # A few rows from the edges of each range; pairs inside a range are known already.
    edges = found.where("edge is not null")
    along = Window.orderBy(*order)
    across = [
        edges.select(
            F.col("node").alias("x"), F.lag("node", k).over(along).alias("y"), "part", F.lag("part", k).over(along).alias("p"),
            "tree", F.lag("tree", k).over(along).alias("t"),
            F.substring("key", 1, 4 * least_depth).alias("k"),
            F.substring(F.lag("key", k).over(along), 1, 4 * least_depth).alias("l"),
        ).where("part <> p and tree = t and k = l").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        for k in range(1, width + 1)
    ]
    pairs = found.where("a is not null and a <> b").select("a", "b")
    for some in across:
        pairs = pairs.unionByName(some.where("a <> b"))
    pairs = staged(pairs.distinct(), "candidates")
    released(found)
    return pairs


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups of texts whose sets of word shingles are alike.

    Texts with the same set are one class, so copies cost one row. Each class has a MinHash signature;
    an LSH forest sorts the classes by ``TREES`` different stretches of it, each order dealt out in ranges
    of equal size, whatever the groups. Neighbours with the longest common prefixes are candidates; the
    depth of the prefix follows from how crowded the region is. A pair whose signatures agree in too few
    values is dropped, all others are checked on the full sets: they are linked when
    100 * intersection >= ``percent`` * union. Groups are the connected components of the links.
    What the forest leaves in different groups is joined exactly, so no group is split: see ``_completed``.

    Words are runs of characters other than white space, letters A-Z lowered. A text of fewer than
    ``words`` words has one shingle, the whole text. Null, empty and blank texts have none and are linked
    with nothing. Rows that share an id count as one document. A null id is linked with nothing: its
    component is null and it is kept. Other columns are ignored.
    Returns ``doc_id, n_shingles, component_id, kept``.
    """
    source = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def sign(columns: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {"doc_id": columns["doc_id"], "n_shingles": [], "low": [], "high": [], "signature": []}
        for text in columns["text"]:
            found = shingle_set(text, words)
            made["n_shingles"].append(len(found))
            made["low"].append(int(np.add.reduce(found).astype(np.int64)))
            made["high"].append(int(np.add.reduce(mix(found ^ np.uint64(0x5851F42D4C957F2D))).astype(np.int64)))
            made["signature"].append(signature(found) if len(found) else None)
        return made

    sets = staged(rows_mapped(source, sign, "doc_id long, n_shingles long, low long, high long, signature binary"), "sets")
    same = ["n_shingles", "low", "high"]
    classes = staged(
        sets.where("n_shingles > 0 and doc_id is not null").groupBy(*same)
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")),
        "classes",
    )
    signatures = classes.select("node", "signature")
    drawn = candidates(signatures)
    likely = staged(_likely(drawn, signatures, (percent - SLACK) / 100), "pairs")
    released(drawn)
    texts = _texts(likely.select("a").union(likely.select("b")), source)
    alike = staged(_checked(likely, texts, words, percent), "links")
    released(likely, texts)
    found = _completed(alike, classes, source, words, percent)
    member = classes.select(*same, "node").join(found, "node", "left").select(
        *same, F.coalesce("component", "node").alias("component")
    )
    # Classes of many copies make this join uneven on its large side only; adaptive execution splits it.
    return sets.join(member, same, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def _likely(pairs: DataFrame, signatures: DataFrame, share: float) -> DataFrame:
    """Pairs whose signatures agree in at least ``share`` of all values."""
    both = (
        pairs.join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
        .join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
    )

    def keep(columns: dict[str, list]) -> dict[str, list]:
        some = [i for i, (x, y) in enumerate(zip(columns["x"], columns["y"])) if agreement(x, y) >= share]
        return {name: [columns[name][i] for i in some] for name in ("a", "b")}

    return rows_mapped(both.select("a", "b", "x", "y"), keep, "a long, b long")


def _texts(nodes: DataFrame, source: DataFrame) -> DataFrame:
    """The texts of the ids in the only column of ``nodes``."""
    named = nodes.toDF("doc_id").distinct()
    # The ids of pairs grow with the texts: they are shuffled at every size, never broadcast.
    return staged(source.join(named.hint("merge"), "doc_id", "left_semi"), "texts")


def _checked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets are alike enough. The texts of pairs only are shuffled."""
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    )

    def keep(columns: dict[str, list]) -> dict[str, list]:
        sets: dict[int, np.ndarray] = {}

        def of(node: int, text: str | None) -> np.ndarray:
            if len(sets) > 64:
                sets.clear()
            key = hash((node, text))
            if key not in sets:
                sets[key] = shingle_set(text, words)
            return sets[key]

        rows = zip(columns["a"], columns["b"], columns["x"], columns["y"])
        some = [i for i, (a, b, x, y) in enumerate(rows) if links(of(a, x), of(b, y), percent)]
        return {name: [columns[name][i] for i in some] for name in ("a", "b")}

    return rows_mapped(both.select("a", "b", "x", "y"), keep, "a long, b long")


def _completed(alike: DataFrame, classes: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the groups of ``alike``, joined wherever two of them are linked in truth.

    Two sets that are linked share a shingle among the rarest of both. Each class posts these; a shingle all
    of whose posts are in one group is of no more use. Posts first meet the one with most links among
    those of the same shingle, which joins the variants of an original without their pairs being spelled
    out. Then all pairs of different groups meet, if length and place leave room, and are checked in full.
    """
    enough = f"{100 + percent} * least(a_size - a_place, b_size - b_place) >= {percent} * (a_size + b_size)"
    room = f"100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size) and {enough}"
    sides = (F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
    same = Window.partitionBy("token")

    degrees = alike.select("a").unionByName(alike.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"))
    groups = components(alike, "groups")
    # Groups are known per class, before its posts are spelled out.
    known = classes.select("node", "n_shingles", "low").join(groups.hint("merge"), "node", "left").join(degrees.hint("merge"), "node", "left")
    known = known.withColumns({"part": F.coalesce("component", "node"), "degree": F.coalesce("degree", F.lit(0))}).drop("component")
    prefixes = staged(_prefixes(known, source, words, percent), "prefixes")
    # A post that only probes has its node as a negative number: nothing but token, node and group is dealt out.
    probing = (-1 - F.col("node")).alias("signed")
    posts = prefixes.select("node", "part", "indexed", F.posexplode("prefix").alias("place", "token")).select(
        "token", F.when(F.col("place") < F.col("indexed"), F.col("node")).otherwise(probing).alias("signed"), "part"
    )
    low, high = F.min("part").over(same), F.max("part").over(same)
    shared = posts.withColumns({"low": low, "high": high, "most": F.max("signed").over(same)}).where("low < high and most >= 0")
    few = staged(shared.select("token", F.greatest("signed", -1 - F.col("signed")).alias("node")), "shared")
    place = F.expr("cast(array_position(prefix, token) - 1 as int)").alias("place")
    placed = few.join(prefixes.hint("merge"), "node").select("token", "node", "size", place, "indexed", "degree", "part")
    hub = F.max(F.struct("degree", (-F.col("node")).alias("back"), "size", "place", "part")).over(same)
    met = staged(placed.withColumn("hub", hub).drop("degree"), "met")
    released(few, prefixes)
    texts = _texts(met.select("node"), source)
    central = met.where("part <> hub.part").select(
        F.col("node").alias("a_node"), F.col("size").alias("a_size"), F.col("place").alias("a_place"),
        (-F.col("hub.back")).alias("b_node"), F.col("hub.size").alias("b_size"), F.col("hub.place").alias("b_place"),
    )
    tried = staged(central.where(room).select(*sides).distinct(), "central")
    more = staged(_checked(tried, texts, words, percent), "links")
    if not more.isEmpty():
        alike = alike.unionByName(more)
        groups = components(alike, "groups")
    again = met.drop("part").join(groups.hint("merge"), "node", "left").select(
        "token", "node", "size", "place", "indexed", F.coalesce("component", "node").alias("part")
    )
    apart = staged(again.withColumns({"low": low, "high": high}).where("low < high").drop("low", "high"), "apart")
    released(met)
    # The smaller set of a pair has the first token in common among its indexed ones.
    a, b = (apart.select("token", *(F.col(c).alias(f"{side}_{c}") for c in apart.columns if c != "token")) for side in "ab")
    smaller = "(a_size < b_size or a_size = b_size and a_node < b_node)"
    rest = a.where("a_place < a_indexed").join(b, "token").where(f"{smaller} and a_part <> b_part and {room}").select(*sides).distinct()
    rest = staged(rest.join(tried.hint("merge"), ["a", "b"], "left_anti"), "rest")
    more = staged(_checked(rest, texts, words, percent), "links")
    released(apart, tried, rest, texts)
    return groups if more.isEmpty() else components(alike.unionByName(more), "groups")


def _prefixes(classes: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, part, degree, size, indexed, prefix) of every class: so many of its rarest shingles that a linked set has one too.

    Of two linked sets the smaller one has the first common shingle among its first ``indexed`` ones, since the overlap is
    then a larger share of it.
    """
    levels = _rarity(source, words)

    def cut(columns: dict[str, list]) -> dict[str, list]:
        table = np.frombuffer(levels, dtype=np.uint8)
        made: dict[str, list] = {name: [] for name in ("node", "n_shingles", "low", "size", "indexed", "prefix")}
        for node, text in zip(columns["doc_id"], columns["text"]):
            found = shingle_set(text, words)
            if node is None or not len(found):
                continue
            length = len(found) - -(-percent * len(found) // 100) + 1
            order = np.lexsort((found, table[(found & np.uint64(COUNTERS - 1)).astype(np.int64)]))[:length]
            indexed = len(found) - -(-2 * percent * len(found) // (100 + percent)) + 1
            values = (node, len(found), int(np.add.reduce(found).astype(np.int64)), len(found), indexed, found[order].astype(np.int64))
            for column, value in zip(made.values(), values):
                column.append(value)
        return made

    cuts = rows_mapped(source, cut, "node long, n_shingles long, low long, size int, indexed int, prefix array<long>")
    # Copies of a class have other ids than its node; rows that repeat the id and the text are dropped below.
    return cuts.join(classes.hint("merge"), ["node", "n_shingles", "low"]).select("node", "part", "degree", "size", "indexed", "prefix")


def _rarity(source: DataFrame, words: int) -> bytes:
    """How many texts have a shingle of each counter, as eight times the binary logarithm.

    One byte per counter, whatever the table. It only orders shingles; no result depends on it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                np.add.at(counts, (shingle_set(text, words) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        for pack, part in enumerate(counts.reshape(-1, PACK)):
            places = np.flatnonzero(part)
            if len(places):
                yield pa.RecordBatch.from_arrays([
                    pa.array([pack], pa.int32()), pa.array([places.astype("<u2").tobytes()], pa.binary()),
                    pa.array([part[places].astype("<u4").tobytes()], pa.binary()),
                ], names=["pack", "places", "counts"])

    def total(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(PACK, dtype=np.int64)
        for batch in batches:
            for places, counts in zip(batch.column("places").to_pylist(), batch.column("counts").to_pylist()):
                sums[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<u4")
        levels = np.minimum(255, 8 * np.log2(sums + 1)).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([levels], pa.binary())], names=["pack", "levels"])

    packs = source.select("text").mapInArrow(count, "pack int, places binary, counts binary")
    made = bytearray(COUNTERS)
    for row in packs.groupBy("pack").applyInArrow(total, "pack int, levels binary").collect():
        made[row["pack"] * PACK : (row["pack"] + 1) * PACK] = row["levels"]
    return bytes(made)
