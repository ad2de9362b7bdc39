"""Nearest neighbours by a block matrix join.

Vectors are scaled to length 1 and rounded to int8 with one step per vector.
Query blocks meet candidate blocks in tiles; a tile is one matrix product. With
``q`` the rounded and ``u`` the true vector, ``|u - q|`` is known for each
vector, so each product comes with a bound of its error:

    |u.v - q.r| <= |u - q| + (1 + |u - q|) |v - r|

A pair survives if its upper bound reaches the k-th largest lower bound of its
query in the tile, where an id counts once, by its best lower bound. Survivors are computed anew in double precision from the
original vectors; tile results are merged by one heap per query. So the answer
is that of a full search.
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

K = 5
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
# Queries of a tile that are multiplied at a time, and pairs that are computed anew at a time.
QUERY_ROWS = 256
EXACT_PAIRS = 100_000
# Above the rounding of the bounds themselves.
SLACK = 1e-6
BLOCKS = "dim int, block int, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _packed(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of about ``size`` vectors, dealt out by hash."""
    blocks = max(1, math.ceil(vectors.count() / size))
    dealt = vectors.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block"),
        "id",
        "vector",
    )

    def pack(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy().astype("<i8")
        values = table["vector"].combine_chunks().flatten().to_numpy().astype("<f8")
        row = {
            "dim": table["dim"][:1].combine_chunks(),
            "block": table["block"][:1].combine_chunks(),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "vectors": pa.array([values.tobytes()], pa.binary()),
        }
        return pa.table(row)

    return dealt.groupBy("dim", "block").applyInArrow(pack, BLOCKS)


class Rounded:
    """Unit vectors in int8 steps, with the length of what rounding took."""

    def __init__(self, vectors: np.ndarray):
        # Scaling by the largest component first keeps the squares finite.
        top = np.abs(vectors).max(axis=1, keepdims=True)
        unit = vectors / top
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        self.step = np.abs(unit).max(axis=1) / 127
        whole = np.rint(unit / self.step[:, None]).astype(np.int8)
        self.error = np.sqrt(((unit - whole * self.step[:, None]) ** 2).sum(axis=1))
        # Products of int8 numbers are whole; a float type that holds the sums keeps them exact.
        self.whole = whole.astype(np.float32 if vectors.shape[1] * 127**2 < 1 << 24 else np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` and of ``b``, added up component by component."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for i in range(a.shape[1]):
        x, y = a[:, i], b[:, i]
        dot += x * y
        aa += x * x
        bb += y * y
    with np.errstate(over="ignore", under="ignore"):
        both = aa * bb
    normal = (both > 1e-300) & np.isfinite(both)
    return dot / np.where(normal, np.sqrt(both), np.sqrt(aa) * np.sqrt(bb))


def tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, candidate, score): the nearest ``k`` candidates of this tile."""
    q, c = Rounded(queries), Rounded(vectors)
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
    for start in range(0, len(queries), QUERY_ROWS):
        rows = slice(start, start + QUERY_ROWS)
        near = (q.whole[rows] @ c.whole.T) * q.step[rows, None] * c.step
        bound = q.error[rows, None] + (1 + q.error[rows, None]) * c.error + SLACK
        low = near - bound
        own = query_ids[rows, None] == ids
        low[own] = -np.inf
        # Several vectors of one id fill one place only.
        of_id = low if len(first) == len(ids) else np.maximum.reduceat(low[:, order], first, axis=1)
        least = (
            np.partition(of_id, -k, axis=1)[:, -k] if len(first) > k else np.full(len(low), -np.inf)
        )
        x, y = np.nonzero((near + bound >= least[:, None]) & ~own)
        best: dict[int, list[tuple[float, int]]] = {}
        for at in range(0, len(x), EXACT_PAIRS):
            a, b = x[at : at + EXACT_PAIRS] + start, y[at : at + EXACT_PAIRS]
            score = cosines(queries[a], vectors[b])
            for i, s, v in zip(a.tolist(), score.tolist(), ids[b].tolist()):
                _push(best.setdefault(i, []), s, v, k)
        for i, heap in best.items():
            held = np.array([v for _, v in heap]), np.array([s for s, _ in heap])
            yield np.full(len(heap), query_ids[i]), -held[0], held[1]


def _push(heap: list[tuple[float, int]], score: float, number: int, k: int) -> None:
    """Keep the ``k`` largest scores, of equal ones the smaller number; a
    number that is there already keeps its larger score."""
    entry = (score, -number)
    for i, (s, v) in enumerate(heap):
        if v == -number:
            if score > s:
                heap[i] = entry
                heapq.heapify(heap)
            return
    if len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    number: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows by cosine.

    Queries are the rows for which ``is_query`` holds. Rows without an id and
    vectors that are null, zero or hold null or non-finite components take no
    part; vectors of another dimension are no candidates. Rows with the id of
    the query are not among its neighbours; if an id has several vectors, its
    best one counts. Equal scores go to the smaller id. Too few candidates
    give fewer rows, an empty table none.

    Of rows with the same vector only the ``k + 1`` smallest ids can be among
    the nearest of any query, so the others are left out before the join.
    """
    usable_rows = vectors.where(usable(F.col(vector)) & F.col(number).isNotNull())
    rows = usable_rows.select(
        F.col(number).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    same = Window.partitionBy("vector").orderBy("id")
    distinct = rows.select("id", "vector").distinct()
    candidates = written(
        distinct.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("place"),
        "candidates",
    )
    queries = written(rows.where("asks").select("id", "vector").distinct(), "queries")
    right = written(_packed(candidates, CANDIDATE_BLOCK), "candidate-blocks")
    left = _packed(queries, QUERY_BLOCK).select(
        "dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")
    )
    listed = right.groupBy("dim").agg(F.collect_list("block").alias("blocks"))
    tiles = left.join(listed, "dim").withColumn("block", F.explode("blocks")).drop("blocks")
    meeting = tiles.join(right.hint("shuffle_merge"), ["dim", "block"])

    def multiply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            dim = batch["dim"][i].as_py()
            parts = []
            for ids, values in (("query_ids", "queries"), ("ids", "vectors")):
                parts.append(np.frombuffer(batch[ids][i].as_buffer(), "<i8"))
                parts.append(np.frombuffer(batch[values][i].as_buffer(), "<f8").reshape(-1, dim))
            for query, near, score in tile(*parts, k):
                yield pa.record_batch({"query_id": query, "vec_id": near, "score": score})

    found = arrow_rows(meeting, multiply, "query_id bigint, vec_id bigint, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for q, v, s in zip(*(c.to_pylist() for c in batch.columns)):
                _push(heaps.setdefault(q, []), s, v, k)
        made = [
            (q, i, -v, s)
            for q, heap in heaps.items()
            for i, (s, v) in enumerate(sorted(heap, reverse=True), 1)
        ]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        columns = list(zip(*made)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["query_id", "rank", "vec_id", "score"],
        )

    return found.repartition("query_id").mapInArrow(
        merge, "query_id bigint, rank int, vec_id bigint, score double"
    )
