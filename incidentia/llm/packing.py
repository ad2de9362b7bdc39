"""Packing of token pieces into sequences of a fixed size.

Every document becomes its token ids and an end id; what is longer than a
sequence is cut. Pieces are packed by pattern: the number of pieces of each
length is all that the plan needs, and it has at most ``size`` entries however
many documents there are.

1. Lengths are rounded up to a grid, and all patterns of up to ``PATTERN``
   grid lengths that fill a sequence are listed.
2. Non-negative least squares fits how often each pattern is used to the
   number of pieces of each length.
3. The counts are rounded down and carried out on the exact lengths; the last
   piece of a pattern is the longest that fits.
4. The remaining pieces go, longest first, into the gap that fits best.

The plan is a short list of recipes (lengths, how many sequences). A piece
finds its place by its rank among the pieces of its length, without moving
any tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentia.llm.common import few_texts
from incidentia.llm.tokens import ENCODE_BYTES, WordEncoder, slices
from incidentia.session import written

SIZE = 2048
END = 0
PATTERN = 3
GRID = 256

Recipe = tuple[tuple[int, ...], int]


# ---- Plan -----------------------------------------------------------------------


def patterns(steps: int, most: int = PATTERN) -> list[tuple[int, ...]]:
    """Falling lists of at most ``most`` positive numbers with the sum ``steps``."""

    def grow(left: int, top: int, room: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif room:
            for first in range(min(left, top), -(-left // room) - 1, -1):
                for rest in grow(left - first, first, room - 1):
                    yield (first, *rest)

    return list(grow(steps, steps, most))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ``x >= 0`` with the smallest ``|a x - b|``, by active sets."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= limit:
            break
        active[best] = True
        while True:
            used = np.flatnonzero(active)
            own = a[:, used]
            fit = np.linalg.solve(own.T @ own + 1e-9 * np.eye(len(used)), own.T @ b)
            if (fit > 0).all():
                x[:] = 0
                x[used] = fit
                break
            low = fit <= 0
            now = x[used]
            step = (now[low] / (now[low] - fit[low])).min()
            x[used] = now + step * (fit - now)
            out = used[low & (x[used] <= limit * 1e-3)]
            if not len(out):
                out = used[low]
            x[out] = 0
            active[out] = False
    return x


def _take(counts: np.ndarray, lo: int, hi: int, many: int) -> list[tuple[int, int]]:
    """(length, number) of ``many`` pieces with lengths from ``lo`` + 1 to ``hi``, longest first."""
    out = []
    for length in range(hi, lo, -1):
        n = min(many, int(counts[length]))
        if n:
            out.append((length, n))
            counts[length] -= n
            many -= n
        if not many:
            break
    return out


def _zipped(runs: list[list[tuple[int, int]]]) -> Iterator[Recipe]:
    """Recipes that take one length of each list at a time."""
    stacks = [list(reversed(r)) for r in runs]
    while stacks[0]:
        many = min(s[-1][1] for s in stacks)
        yield tuple(s[-1][0] for s in stacks), many
        for s in stacks:
            length, n = s.pop()
            if n > many:
                s.append((length, n - many))


def _by_pattern(counts: np.ndarray, size: int) -> list[Recipe]:
    """Recipes of fitted patterns; ``counts`` keeps what they leave over."""
    width = -(-size // GRID)
    steps = size // width
    edges = [width * i for i in range(steps)] + [size]
    held = np.add.reduceat(counts[1:].astype(float), edges[:-1])
    listed = [p for p in patterns(steps) if all(held[s - 1] for s in p)]
    if not listed:
        return []
    a = np.zeros((steps, len(listed)))
    for j, p in enumerate(listed):
        for s in p:
            a[s - 1, j] += 1
    used = np.floor(nnls(a, held) + 1e-6).astype(int)
    recipes: list[Recipe] = []
    for j in np.argsort(-used, kind="stable"):
        p = listed[j]
        bins = [(edges[s - 1], edges[s]) for s in p]
        room = [int(counts[lo + 1 : hi + 1].sum()) // p.count(s) for s, (lo, hi) in zip(p, bins)]
        many = min(int(used[j]), *room)
        if many:
            runs = [_take(counts, lo, hi, many) for lo, hi in bins[:-1]]
            for lengths, n in _zipped(runs) if runs else [((), many)]:
                recipes += _completed(lengths, n, counts, size)
    return recipes


def _completed(lengths: tuple[int, ...], many: int, counts: np.ndarray, size: int) -> list[Recipe]:
    """Recipes with a last piece that fits best: the longest that is left."""
    out, gap = [], size - sum(lengths)
    while many:
        fits = np.flatnonzero(counts[: gap + 1])
        if not len(fits):
            return [*out, (lengths, many)] if lengths else out
        n = min(many, int(counts[fits[-1]]))
        counts[fits[-1]] -= n
        out.append(((*lengths, int(fits[-1])), n))
        many -= n
    return out


def _fill(recipes: list[Recipe], counts: np.ndarray, size: int) -> list[Recipe]:
    """Put the remaining pieces, longest first, into the tightest gaps."""
    open_: list[list[Recipe]] = [[] for _ in range(size + 1)]
    there = np.zeros(size + 1, bool)

    def add(lengths: tuple[int, ...], many: int) -> None:
        gap = size - sum(lengths)
        open_[gap].append((lengths, many))
        there[gap] = True

    for lengths, many in recipes:
        add(lengths, many)
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(there[length:])
            if len(fits):
                gap = length + int(fits[0])
                lengths, many = open_[gap].pop()
                there[gap] = bool(open_[gap])
                n = min(many, left)
                if many > n:
                    add(lengths, many - n)
                add((*lengths, length), n)
            else:
                each = min(size // length, left)
                n = left // each
                add((length,) * each, n)
                n *= each
            left -= n
    return [r for group in open_ for r in group]


def plan(counts: np.ndarray, size: int = SIZE) -> list[Recipe]:
    """Recipes that hold ``counts[n]`` pieces of each length ``n`` (1 to ``size``)."""
    left = np.array(counts, np.int64)
    return _fill(_by_pattern(left, size), left, size)


class Places:
    """Where the piece with a given length and rank goes."""

    def __init__(self, recipes: list[Recipe], size: int):
        rows, used, sequence = [], [0] * (size + 1), 0
        for lengths, many in recipes:
            offset = 0
            for length in lengths:
                rows.append((length, used[length], sequence, offset))
                used[length] += many
                offset += length
            sequence += many
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.length, self.low, self.sequence, self.offset = table.T
        self.first = np.searchsorted(self.length, np.arange(size + 2))
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            a, b = self.first[n], self.first[n + 1]
            at[own] = a + np.searchsorted(self.low[a:b], rank[own], "right") - 1
        return self.sequence[at] + rank - self.low[at], self.offset[at]


# ---- Pieces ---------------------------------------------------------------------

PIECE = (
    "doc_id bigint, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint, "
    "part int, rank bigint"
)
_KINDS = (
    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()
)


def pieces(docs: DataFrame, tokenizer: str, doc_id: str, text: str, size: int = SIZE) -> DataFrame:
    """The token pieces of each row, with ``rank`` among the pieces of their
    length in the task ``part``. To be written once before use, for a task that
    runs again may see its rows in another order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        ranks = [0] * (size + 1)
        for batch in batches:
            for rows in slices(batch, most=ENCODE_BYTES):
                ids, edges = encoder.encode(rows["text"])
                made: list[tuple] = []
                for i, number in enumerate(rows["doc_id"].to_pylist()):
                    own = np.append(ids[edges[i] : edges[i + 1]], np.uint32(END)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), size)):
                        cut = own[start : start + size]
                        n, data = len(cut), cut.tobytes()
                        made.append(
                            (number, k, start, n, cut.astype("<u2").tobytes() if short else data,
                             zlib.crc32(data), part, ranks[n])
                        )
                        ranks[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), _KINDS)],
                    names=[f.split()[0] for f in PIECE.split(", ")],
                )

    from tokenizers import Tokenizer

    short = Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(run, PIECE)


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    size: int = SIZE,
) -> DataFrame:
    """Pieces of all documents with their ids and place (sequence_id, offset).

    ``ids`` holds little-endian numbers of 16 bits if the vocabulary fits, else
    of 32; ``ids_crc32`` is taken over 32-bit ones. Null and empty texts give
    one piece that is the end id alone. Rows without an id are packed as well;
    repeated rows are packed each. No documents give no pieces. The places
    within a sequence leave no gap from 0 on.
    """
    with few_texts(docs.sparkSession):
        made = written(pieces(docs, tokenizer, doc_id, text, size), "pieces")
    counted = written(made.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(size + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size`
        counts[row.length] = row.n
    places = Places(plan(counts, size), size)
    earlier = Window.partitionBy("length").orderBy("part")
    bases = counted.select(
        "part", "length", (F.sum("n").over(earlier) - F.col("n")).alias("base")
    )
    ranked = made.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    kept = ["doc_id", "piece", "start", "length", "ids", "ids_crc32"]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.select(*kept, place("length", "rank").alias("at")).select(*kept, "at.*")
