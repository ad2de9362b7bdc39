"""SimHash near-duplicates: fingerprints, a trie self-join, components.

A fingerprint has 64 bits. Two fingerprints link if they differ in at most
``distance`` bits. By the pigeonhole principle they then agree on ``equal``
whole blocks if the bits are cut into ``distance + equal`` blocks. So for each
choice of ``equal`` blocks the fingerprints that agree on these bits are the
leaves of one binary trie over the other bits, and the join runs trie by trie:

* node pairs are walked together from the root, ``diff`` adds up the bits in
  which their paths differ, and a pair is dropped once ``diff`` exceeds the
  budget;
* a trie with many leaves is cut into parts, and each pair of parts is a task
  of its own, so no task grows with the size of a group;
* what a task returns is a spanning forest of the links it found, never all
  pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import arrow_rows, fresh, id_or_last, null_if_last, spread_join
from incidentia.llm.components import components
from incidentia.session import written

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Expected leaves of a trie, and leaves of one part of a trie.
TRIE_LEAVES = 256
PART_LEAVES = 2048
# Leaves per task, and node pairs that a task walks at a time.
TASK_LEAVES = 200_000
PAIRS = 2_000_000
BLOCK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = len(words) - size + 1
    first, last = starts[:n].tolist(), (ends[size - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(first[i : i + BLOCK], last[i : i + BLOCK])],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def text_key(text: str) -> Column:
    """The same for equal texts only; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256))


def fingerprints(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    *,
    with_key: bool = False,
) -> DataFrame:
    """(doc_id, fp[, key]) of each row; ``fp`` is the fingerprint as a signed
    long, ``key`` the ``text_key``."""
    schema = "doc_id bigint, fp bigint" + ", key binary" * with_key

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
        columns = {"doc_id": batch["doc_id"], "fp": pa.array(marks.view(np.int64))}
        if with_key:
            columns["key"] = batch["key"]
        yield pa.record_batch(columns)

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *[text_key(text).alias("key")] * with_key,
    )
    return arrow_rows(rows, run, schema)


# ---- Trie self-join -------------------------------------------------------------


def _blocks(count: int) -> list[int]:
    """Masks of ``count`` blocks of bits, together all 64."""
    edges = [round(64 * i / count) for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def masks(leaves: int, distance: int) -> list[int]:
    """For each trie family the bits on which its leaves agree.

    More fingerprints need more agreeing blocks, so that a trie of evenly
    spread fingerprints keeps about ``TRIE_LEAVES`` leaves at any input size.
    """
    equal = 1
    while leaves / 2 ** (64 * equal / (distance + equal)) > TRIE_LEAVES and equal < 4:
        equal += 1
    return [sum(c) for c in combinations(_blocks(distance + equal), equal)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _free_bits_first(values: np.ndarray, mask: int) -> tuple[np.ndarray, int]:
    """The bits outside ``mask``, packed from the highest bit on, and their number."""
    out, free = np.zeros_like(values), [b for b in range(63, -1, -1) if not mask >> b & 1]
    for i, b in enumerate(free):
        out |= ((values >> np.uint64(b)) & np.uint64(1)) << np.uint64(63 - i)
    return out, len(free)


def walk(leaves: np.ndarray, roots: np.ndarray, depth: int, distance: int) -> np.ndarray:
    """Linked pairs (positions in ``leaves``) within each of several tries.

    ``leaves`` is sorted within each trie; trie ``i`` covers the positions
    ``roots[i]`` to ``roots[i + 1]``. A node is a range of positions.
    """
    found = []
    a0, a1 = roots[:-1].copy(), roots[1:].copy()
    b0, b1, diff = a0.copy(), a1.copy(), np.zeros(len(a0), np.int8)
    for level in range(depth + 1):
        own = a0 == b0
        keep = ~(own & (a1 - a0 <= 1))
        single = ~own & (a1 - a0 == 1) & (b1 - b0 == 1)
        x, y = a0[single], b0[single]
        near = np.bitwise_count(leaves[x] ^ leaves[y]) <= distance
        found.append(np.stack([x[near], y[near]], axis=1))
        keep &= ~single
        a0, a1, b0, b1, diff, own = (v[keep] for v in (a0, a1, b0, b1, diff, own))
        if level == depth or not len(a0):
            break
        bit = (leaves >> np.uint64(63 - level)) & np.uint64(1)
        ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        parts = [
            (a0, am, b0, bm, diff),
            (am, a1, bm, b1, diff),
            (a0, am, bm, b1, diff + 1),
            tuple(v[~own] for v in (am, a1, b0, bm, diff + 1)),
        ]
        a0, a1, b0, b1, diff = (np.concatenate(v) for v in zip(*parts))
        live = (a1 > a0) & (b1 > b0) & (diff <= distance)
        a0, a1, b0, b1, diff = (v[live] for v in (a0, a1, b0, b1, diff))
    return np.concatenate(found)


def forest(pairs: np.ndarray, size: int) -> np.ndarray:
    """The smallest position reachable from each position."""
    root = np.arange(size)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    return root


def _join_tries(rows: pa.Table, families: list[int], distance: int) -> Iterator[pa.RecordBatch]:
    family = rows["family"].to_numpy()
    for f in np.unique(family):
        own = family == f
        marks = rows["fp"].to_numpy()[own].view(np.uint64)
        cell = rows["key"].to_numpy()[own], rows["p"].to_numpy()[own], rows["q"].to_numpy()[own]
        path, depth = _free_bits_first(marks, families[f])
        order = np.lexsort((path, *reversed(cell)))
        path, marks = path[order], marks[order]
        change = np.zeros(len(path), bool)
        for part in cell:
            change[1:] |= np.diff(part[order]) != 0
        roots = np.concatenate(([0], np.flatnonzero(change), [len(path)]))
        work = np.cumsum(np.diff(roots) ** 2) // PAIRS
        for w in np.unique(work):
            i = np.flatnonzero(work == w)
            lo, hi = roots[i[0]], roots[i[-1] + 1]
            tree = forest(walk(path[lo:hi], roots[i[0] : i[-1] + 2] - lo, depth, distance), hi - lo)
            linked = np.flatnonzero(tree != np.arange(hi - lo))
            own_marks = marks[lo:hi].view(np.int64)
            yield pa.record_batch({"a": own_marks[linked], "b": own_marks[tree[linked]]})


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join the same fingerprints as all links together.

    ``classes`` holds each fingerprint ``fp`` once.
    """
    leaves = classes.count()
    families = masks(leaves, distance)
    tries = classes.select("fp").select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in families])).alias(
            "family", "key"
        ),
    )
    large = (
        tries.groupBy("family", "key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > PART_LEAVES)
        .select("family", "key", F.ceil(F.col("n") / PART_LEAVES).cast("int").alias("parts"))
    )
    # At most (leaves * families / PART_LEAVES) rows of 20 bytes.
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1)
    ))
    cells = (
        tries.join(F.broadcast(large), ["family", "key"], "left")
        .select("fp", "family", "key", F.coalesce(part, F.lit(0)).alias("part"), other.alias("o"))
        .select("fp", "family", "key", F.least("part", "o").alias("p"), F.greatest("part", "o").alias("q"))
    )
    tasks = max(
        int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(leaves * len(families) / TASK_LEAVES),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from _join_tries(pa.Table.from_batches(held), families, distance)

    return cells.repartition(tasks, "family", "key", "p", "q").mapInArrow(run, "a bigint, b bigint")


# ---- Operators ------------------------------------------------------------------


def _rooted(marked: DataFrame, first: Column, distance: int) -> DataFrame:
    """(fp, least, n, root) of each fingerprint in ``marked``: the smallest
    ``first`` and the number of its rows, and the root of its component."""
    classes = written(
        marked.groupBy("fp").agg(F.min(first).alias("least"), F.count("*").alias("n")),
        "fingerprint-classes",
    )
    roots = components(links(classes, distance), "a", "b").withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return written(rooted, "fingerprint-roots")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest document id that links lead to. Null and
    empty texts have fingerprint 0 and link like any other. Rows without an id
    take part; they come last in the choice of the smallest id, so
    ``component_id`` is null only where no document of the component has one.
    Repeated rows are returned as often as they occur. An empty table gives an
    empty result.
    """
    marked = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    rooted = _rooted(marked, id_or_last("doc_id"), distance)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = written(rooted.join(named, "root").select("fp", "component_id", "n"), "components")
    joined = spread_join(marked, found, ["fp"], F.xxhash64("doc_id"))
    return joined.select("doc_id", "fp", null_if_last(F.col("component_id")).alias("component_id"))


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """Rows of ``docs`` that are the first of their component, all columns kept.

    A component keeps the document with the smallest id. If several texts have
    that id, or no document has one, the text with the smallest key stays; of
    rows with one id and one text one stays.
    """
    own, key = fresh(docs.columns, "own_id"), fresh(docs.columns, "own_key")
    marked = written(fingerprints(docs, doc_id, text, shingle, with_key=True), "fingerprints")
    rooted = _rooted(marked, F.struct(id_or_last("doc_id").alias("id"), "key"), distance)
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    kept = least.select(F.col("least.id").alias(own), F.col("least.key").alias(key))
    rows = docs.withColumns({own: id_or_last(doc_id), key: text_key(text)})
    return rows.join(kept, [own, key], "left_semi").dropDuplicates([own, key]).select(
        *(rows[c] for c in docs.columns)
    )


def fingerprint_text(fp: str = "fp") -> Column:
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
