"""Hard negatives by largest inner product, searched in cover trees.

Candidates are dealt into blocks, and each block becomes a cover tree over its
norm-augmented vectors: one more component brings all of them to the largest
norm, so the largest inner product is the nearest point. A level divides by
``BASE`` the radius its centres cover; each node keeps the largest distance of
what lies below it. For a query ``q`` and a node with centre ``c`` and radius ``r``

    q.c - |q| r  <=  q.x  <=  q.c + |q| r

holds for every ``x`` below. A search takes a window of scores and goes down best
first, by the upper bound cut off at the window's top. Nodes outside the window
are skipped, leaves are compared as whole numbers, and it stops when no bound
reaches the last score it keeps. So the result is that of a full search.

Two searches run over the same trees: the nearest rows of an anchor's own label
are its positives; each positive opens a window in which the nearest rows of
other labels are the hard negatives.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentia.llm.common import arrow_rows
from incidentia.session import written

POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
BLOCK_ROWS = 4096
ANCHOR_ROWS = 512
BASE = 2.0
# Whole numbers below this are exact as doubles.
EXACT = 2.0**53
# Above the rounding of bounds.
SLACK = 1e-9

TREE = """dim int, block int, ids binary, labels binary, vectors binary,
    point binary, radius binary, first binary, last binary"""
ANCHORS = "dim int, part int, keys binary, ids binary, labels binary, vectors binary, windows binary"
FOUND = "key bigint, anchor_id bigint, window bigint, id bigint, score bigint"


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(",")]


class CoverTree:
    """Nodes in arrays, the children of a node side by side.

    ``point`` is the row of a node's centre, ``radius`` the largest distance
    from it to a row below, ``first`` and ``last`` are its children; a leaf has
    none. Rows with equal vectors are one point.
    """

    def __init__(self, vectors: np.ndarray):
        values = vectors.astype(float)
        norms = (values * values).sum(axis=1)
        lift = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        self.lifted = np.concatenate([values, lift[:, None]], axis=1)
        self.point, self.radius, self.first, self.last = [], [], [], []
        everyone = np.arange(len(vectors))
        apart = self._apart(0, everyone)
        self._add(0, apart.max())
        waiting = [(0, everyone, apart, apart.max())] if len(vectors) > 1 else []
        while waiting:
            node, rows, apart, level = waiting.pop()
            self.first[node] = len(self.point)
            # As doubles, different vectors may be equal: then each is a leaf.
            parts = [] if apart.any() else [(rows[i : i + 1], apart[i : i + 1]) for i in range(len(rows))]
            level = min(level, apart.max())
            while len(parts) < 2:
                level /= BASE
                parts = self._covered(rows, apart, level)
            for members, distances in parts:
                child = self._add(members[0], distances.max())
                if len(members) > 1:
                    waiting.append((child, members, distances, level))
            self.last[node] = len(self.point)
        as_array = lambda x, kind: np.array(x, dtype=kind)
        self.point, self.first, self.last = (
            as_array(x, "<i4") for x in (self.point, self.first, self.last)
        )
        self.radius = as_array(self.radius, "<f8")

    def _add(self, point: int, radius: float) -> int:
        for column, value in zip((self.point, self.radius, self.first, self.last), (point, radius, 0, 0)):
            column.append(value)
        return len(self.point) - 1

    def _apart(self, centre: int, rows: np.ndarray) -> np.ndarray:
        difference = self.lifted[rows] - self.lifted[centre]
        return np.sqrt((difference * difference).sum(axis=1))

    def _covered(
        self, rows: np.ndarray, apart: np.ndarray, level: float
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows dealt to centres that cover them within ``level``; the centre
        comes first. The first centre is that of the node above."""
        parts = []
        while len(rows):
            near = apart <= level
            near[0] = True
            parts.append((rows[near], apart[near]))
            rows = rows[~near]
            if len(rows):
                apart = self._apart(rows[0], rows)
        return parts


def _packed_tree(table: pa.Table) -> pa.Table:
    """A block of candidates as one row: its vectors, sorted so that equal ones
    lie together, and the tree over the distinct ones."""
    ids = table["id"].to_numpy()
    labels = table["label"].to_numpy()
    dim = table["dim"][0].as_py()
    vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
    if dim:
        distinct, place = np.unique(vectors, axis=0, return_inverse=True)
    else:
        distinct, place = vectors[:1], np.zeros(len(ids), int)
    order = np.lexsort((ids, place.ravel()))
    starts = np.searchsorted(place.ravel()[order], np.arange(len(distinct) + 1))
    tree = CoverTree(distinct)
    arrays = [tree.point, tree.radius, tree.first, tree.last]
    # Ids and labels carry where the rows of each distinct vector begin.
    held = [np.concatenate([[len(distinct)], starts, ids[order]]), labels[order], distinct]
    blobs = [x.astype("<i8").tobytes() for x in held] + [x.tobytes() for x in arrays]
    columns = [table["dim"][:1].combine_chunks(), table["block"][:1].combine_chunks()]
    columns += [pa.array([b], pa.binary()) for b in blobs]
    return pa.Table.from_arrays(columns, names=_names(TREE))


class Searched:
    """A block read back, ready for searches."""

    def __init__(self, row: dict):
        held = np.frombuffer(row["ids"], "<i8")
        count = int(held[0])
        self.starts = held[1 : count + 2]
        self.ids = held[count + 2 :]
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<i8").reshape(count, row["dim"])
        self.point, self.first, self.last = (
            np.frombuffer(row[n], "<i4") for n in ("point", "first", "last")
        )
        self.radius = np.frombuffer(row["radius"], "<f8")
        self.values = self.vectors.astype(float)
        self.largest = np.abs(self.values).max(initial=0.0)
        self.leaf = self.first == self.last
        self._nodes: dict[int, Node] = {}

    def node(self, number: int) -> Node:
        found = self._nodes.get(number)
        if found is None:
            found = self._nodes[number] = Node(self, number)
        return found

    def exact(self, query: np.ndarray) -> bool:
        return self.largest * np.abs(query.astype(float)).max(initial=0.0) * max(len(query), 1) < EXACT


class Node:
    """The children of a node: inner ones with their radius, and the rows of its leaves."""

    def __init__(self, block: Searched, number: int):
        # The root of a block with one vector is its own leaf.
        places = np.arange(block.first[number], block.last[number]) if number or not block.leaf[0] else [0]
        leaf = block.leaf[places]
        self.inner = np.asarray(places)[~leaf]
        self.radius = block.radius[self.inner]
        points = block.point[places]
        ends = points[leaf]
        self.points = np.concatenate([block.point[self.inner], ends])
        self.values = block.values[self.points]
        # Rows of the leaves, and which of them each row belongs to.
        many = block.starts[ends + 1] - block.starts[ends]
        self.of = np.repeat(np.arange(len(ends)), many)
        before = np.cumsum(many) - many
        self.rows = np.arange(many.sum()) + np.repeat(block.starts[ends] - before, many)
        self.ids = block.ids[self.rows]


class Descent:
    """All searches of one anchor in one block; node scores are computed once."""

    def __init__(self, block: Searched, query: np.ndarray):
        self.block = block
        self.query = query
        self.real = query.astype(float)
        self.length = math.sqrt(float(self.real @ self.real)) * (1 + SLACK)
        self.exact = block.exact(query)
        self.known: dict[int, tuple[np.ndarray, ...]] = {}

    def _scored(self, node: Node) -> tuple[np.ndarray, ...]:
        """Upper and lower bounds of the inner children, exact scores of the leaves' rows."""
        if self.exact:
            scores = (node.values @ self.real).astype(np.int64)
        else:
            # Python's whole numbers have no limit.
            scores = self.block.vectors[node.points].astype(object) @ self.query.astype(object)
        near = scores[: len(node.inner)].astype(float)
        reach = self.length * node.radius
        reach += SLACK * (reach + np.abs(near))
        return near + reach, near - reach, scores[len(node.inner) :][node.of]

    def best(
        self, k: int, low: int | None, high: int | None, wanted: np.ndarray
    ) -> list[tuple[int, int]]:
        """The first ``k`` rows (score, id) from ``low`` to ``high``, by falling
        score and rising id; ``wanted`` says which rows of the block count."""
        kept: list[tuple[int, int]] = []  # (-score, id), sorted
        least, top = -math.inf if low is None else low, math.inf if high is None else high
        waiting: list[tuple[float, int]] = [(-math.inf, 0)]
        while waiting:
            bound, number = heapq.heappop(waiting)
            if -bound < least:
                break
            node = self.block.node(number)
            found = self.known.get(number)
            if found is None:
                found = self.known[number] = self._scored(node)
            upper, lower, scores = found
            fits = np.flatnonzero(wanted[node.rows] & (scores >= least) & (scores <= top))
            if len(fits) > 4 * k:
                # Equal scores stay together: the id decides among them.
                fits = fits[scores[fits] >= np.partition(scores[fits], -k)[-k]]
            if len(fits):
                kept += zip((-scores[fits]).tolist(), node.ids[fits].tolist())
                kept.sort()
                del kept[k:]
                if len(kept) == k:
                    least = max(least, -kept[-1][0])
            for i in np.flatnonzero((upper >= least) & (lower <= top)).tolist():
                heapq.heappush(waiting, (-min(upper[i], top), int(node.inner[i])))
        return [(-s, i) for s, i in kept]


def whole_components(vector: Column, factor: int = 256) -> Column:
    """Each component times ``factor``, rounded down, as a whole number."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("bigint"))


def _all_finite(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def _trees(rows: DataFrame, most: int, block_rows: int) -> tuple[DataFrame, int]:
    """Blocks with their trees, and how many blocks there are. Of rows that agree in vector and label only the
    ``most`` smallest ids can be among the first ``most`` of any search."""
    same = Window.partitionBy("vector", "label").orderBy("id")
    kept = written(
        rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= most).drop("place"),
        "candidates",
    )
    blocks = max(1, math.ceil(kept.count() / block_rows))
    dealt = kept.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)).cast("int").alias("block"),
        "id",
        "label",
        "vector",
    )
    trees = dealt.groupBy("dim", "block").applyInArrow(_packed_tree, TREE)
    return written(trees, "cover-trees"), blocks


def _packed_anchors(anchors: DataFrame, most: int) -> DataFrame:
    """Anchors ``key, id, label, vector, windows`` in parts of about ``most``."""
    parts = max(1, math.ceil(anchors.count() / most))
    dealt = anchors.select(
        F.size("vector").alias("dim"),
        F.pmod("key", F.lit(parts)).cast("int").alias("part"),
        "key",
        "id",
        "label",
        "vector",
        "windows",
    )

    def pack(table: pa.Table) -> pa.Table:
        columns = [table["dim"][:1].combine_chunks(), table["part"][:1].combine_chunks()]
        windows = table["windows"].combine_chunks()
        counts = np.diff(windows.offsets.to_numpy())
        flat = [table["vector"].combine_chunks().flatten().to_numpy()]
        flat.append(np.concatenate([counts, windows.flatten().to_numpy()]))
        plain = [table[name].to_numpy() for name in ("key", "id", "label")]
        for values in (*plain, *flat):
            columns.append(pa.array([values.astype("<i8").tobytes()], pa.binary()))
        return pa.Table.from_arrays(columns, names=_names(ANCHORS))

    return dealt.groupBy("dim", "part").applyInArrow(pack, ANCHORS)


def _search(
    trees: DataFrame, blocks: int, anchors: DataFrame, k: int, same_label: bool, shares: tuple[int, int]
) -> DataFrame:
    """Every part of the anchors against every tree of its dimension.

    With ``same_label`` an anchor is searched once without limits, else once for
    each positive score in its windows, between the ``shares`` of it.
    """
    left = _packed_anchors(anchors, ANCHOR_ROWS).withColumnsRenamed(
        {"ids": "anchor_ids", "labels": "anchor_labels", "vectors": "anchor_vectors"}
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    meeting = left.withColumn("block", everywhere).join(trees.hint("shuffle_merge"), ["dim", "block"])
    least, most = shares

    def searched(row: dict) -> Iterator[tuple[int, ...]]:
        block = Searched(row)
        keys = np.frombuffer(row["keys"], "<i8")
        ids = np.frombuffer(row["anchor_ids"], "<i8")
        labels = np.frombuffer(row["anchor_labels"], "<i8")
        queries = np.frombuffer(row["anchor_vectors"], "<i8").reshape(len(ids), row["dim"])
        held = np.frombuffer(row["windows"], "<i8")
        counts, windows = held[: len(ids)], np.split(held[len(ids) :], np.cumsum(held[: len(ids)])[:-1])
        plain = keys.tolist(), ids.tolist(), labels.tolist()
        for key, number, label, query, own in zip(*plain, queries, windows):
            descent = Descent(block, query)
            wanted = (block.labels == label if same_label else block.labels != label) & (block.ids != number)
            if same_label:
                for score, found in descent.best(k, None, None, wanted):
                    yield key, number, 0, found, score
                continue
            for score in dict.fromkeys(own.tolist()):
                # least * score <= 100 * x <= most * score, in whole numbers.
                low, high = -(-least * score // 100), most * score // 100
                if low <= high:
                    for negative, found in descent.best(k, low, high, wanted):
                        yield key, number, score, found, negative

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = {n: batch[n][i].as_buffer() if pa.types.is_binary(batch[n].type) else batch[n][i].as_py()
                   for n in batch.schema.names}
            columns = list(zip(*searched(row))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(max(v, -(2**63)), 2**63 - 1) for v in c], pa.int64()) for c in columns],
                names=_names(FOUND),
            )

    return arrow_rows(meeting, run, FOUND)


def _first(found: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    number: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = (LEAST, MOST),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the whole-number vectors, larger ones first,
    equal ones by the smaller id. For each anchor and each of its first
    ``positives`` rows of the same label: the first ``negatives`` rows of other
    labels whose score is between the ``shares`` (in hundredths) of the
    positive's. Fewer candidates give fewer rows, an empty table none.

    Rows without an id or a label take no part, nor do vectors that are null or
    hold null or non-finite components; vectors of another dimension are no
    candidates of an anchor. Rows that agree in id, label and vector are one
    row; an id with several rows counts once for each of them, as an anchor and
    as a candidate, but a row with an anchor's id is never its positive or
    negative.
    Components beyond a 64-bit number count as the nearest one, and so does a
    score. Other columns may have any name.
    """
    kind = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(number).cast("bigint").alias("id"),
        kind.cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & _all_finite(F.col("vector")))
    rows = rows.withColumn("vector", whole_components(F.col("vector"))).distinct()
    # One more than is returned, as the anchor itself may be among them.
    trees, blocks = _trees(rows.drop("asks"), max(positives, negatives) + 1, block_rows)
    # An id may have several rows: each is an anchor of its own.
    key = F.xxhash64("id", "label", "vector").alias("key")
    none = F.array().cast("array<bigint>").alias("windows")
    anchors = written(rows.where("asks").select(key, "id", "label", "vector", none), "anchors")
    near = _search(trees, blocks, anchors, positives, True, shares)
    best = written(_first(near, ["key", "anchor_id"], positives), "positives")
    windows = best.groupBy("key", F.col("anchor_id").alias("id")).agg(F.collect_set("score").alias("windows"))
    asked = anchors.drop("windows").join(windows, ["key", "id"])
    far = _search(trees, blocks, asked, negatives, False, shares)
    ranked = _first(far, ["key", "anchor_id", "window"], negatives)
    pairs = best.select("key", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("window"))
    return pairs.join(ranked, ["key", "anchor_id", "window"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("window").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
