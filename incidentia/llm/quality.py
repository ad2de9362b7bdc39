"""Document quality by Bradley-Terry ranking.

Every document has a strength, a linear function of features of its whole
text. Of two labelled documents the one with label 1 is preferred with the
probability ``sigmoid(strength difference)``; the weights minimise the logistic
loss over all pairs of a document with label 1 and one with label 0. The
threshold is a quantile of the strengths of all labelled documents: the share of
label 0 lies below it. Scores are shifted so that the threshold has the score
``CUT``.

The pairs are not listed. The loss and its derivatives are smooth in both
strengths, so within a cell of strengths of width ``CELL`` they are polynomials
through ``NODES`` Chebyshev nodes, off by less than 1e-12. A document counts at
the nodes of its cell with its Lagrange weights; the sums at the nodes, of a size
that does not depend on the number of documents, stand for all pairs. A step of
the fit is one pass over the features of the labelled documents. Scoring is one
pass over all documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from incidentia.llm.common import arrow_rows, fresh
from incidentia.llm.tokens import slices
from incidentia.llm.words import split_words
from incidentia.session import written

CELL = 1.0
NODES = 12
# Up to so many labels are sent to the texts; beyond that features are shuffled.
BROADCAST_LABELS = 2_000_000
BINS = 4096
RIDGE = 1e-3
CUT = 0.7
FEATURES = 12


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text; all zero without words."""
    words, edges = split_words(texts)
    out = np.zeros((len(texts), FEATURES))
    many = np.diff(edges)
    some = np.flatnonzero(many)
    if not len(some):
        return out
    coded = words.dictionary_encode()
    own, codes = coded.dictionary, coded.indices.to_numpy()
    size = pc.utf8_length(own).to_numpy().astype(float)
    count = lambda pattern: pc.count_substring_regex(own, pattern).to_numpy().astype(float)
    letters, upper = count(r"\pL"), count(r"\p{Lu}")
    marks = size - letters - count(r"\p{N}|\p{M}") - count(r"[.,;:?'’()\"-]")
    by_word = np.stack(
        [
            size,
            (upper > 1) & (upper == letters),
            marks,
            letters == 0,
            count(r"\p{N}"),
            marks > 0,
            pc.match_substring_regex(own, r"[.!?]$").to_numpy(zero_copy_only=False),
            size <= 3,
        ]
    ).astype(np.float32)
    n = many[some]
    place = np.arange(len(codes)) - np.repeat(edges[:-1], many)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, edges[:-1][some], dtype=np.float64) / n

    def again(back: int) -> np.ndarray:
        same = np.zeros(len(codes), np.float32)
        same[back:] = codes[back:] == codes[:-back]
        same[place < back] = 0
        return mean(same)

    means = [mean(row[codes]) for row in by_word]
    shares = [*means[1:], again(1), again(2) + again(3)]
    out[some, 0] = np.log1p(n)
    out[some, 1] = np.log1p(means[0])
    for j, share in enumerate(shares, 2):
        out[some, j] = np.log(0.01 + share) - np.log(0.01)
    out[some, -1] = 1.0
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights of the strengths, and the strength at which a score is ``CUT``."""

    weights: np.ndarray
    threshold: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        lift = np.log(CUT / (1 - CUT))
        gap = np.clip(features(texts) @ self.weights - self.threshold, -700, 700)
        return np.where(gap >= 0, np.maximum(CUT, 1 / (1 + np.exp(-gap - lift))), np.minimum(
            np.nextafter(CUT, 0), 1 / (1 + np.exp(-gap - lift))
        ))


# Sums over documents by label and cell of strengths; one row per node.
Sums = dict[tuple[int, int], np.ndarray]
_CHEBYSHEV = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))


def _at_nodes(place: np.ndarray) -> np.ndarray:
    """Lagrange weights of the nodes, for places from -1 to 1 in a cell."""
    gaps = _CHEBYSHEV[:, None] - _CHEBYSHEV
    np.fill_diagonal(gaps, 1)
    out = np.ones((len(place), NODES))
    for j in range(NODES):
        for k in range(NODES):
            if j != k:
                out[:, j] *= (place - _CHEBYSHEV[k]) / gaps[j, k]
    return out


def node_sums(x: np.ndarray, label: np.ndarray, weights: np.ndarray) -> Sums:
    """Number of documents, sum of features and of their products at each node."""
    strength = x @ weights
    cell = np.floor(strength / CELL).astype(np.int64)
    at = _at_nodes(2 * (strength / CELL - cell) - 1)
    rows = np.concatenate((np.ones((len(x), 1)), x, (x[:, :, None] * x[:, None]).reshape(len(x), -1)), axis=1)
    order = np.lexsort((cell, label))
    new = np.flatnonzero(np.diff(label[order]) | np.diff(cell[order])) + 1
    return {
        (int(label[own[0]]), int(cell[own[0]])): at[own].T @ rows[own]
        for own in np.split(order, new)
        if len(own)
    }


def _derivatives(sums: Sums, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss over all pairs, with its first and second derivative."""
    good, bad = ([(c, v) for (label, c), v in sorted(sums.items()) if label == own] for own in (1, 0))
    nodes = lambda cells: (np.concatenate([c + (_CHEBYSHEV + 1) / 2 for c in cells]) * CELL)
    low, below = nodes([c for c, _ in bad]), np.concatenate([v for _, v in bad])
    split = lambda v: (v[:, 0], v[:, 1 : FEATURES + 1], v[:, FEATURES + 1 :])
    many_b, x_b, xx_b = split(below)
    loss, slope, bend = 0.0, np.zeros(FEATURES), np.zeros((FEATURES, FEATURES))
    pairs = 0.0
    for c, above in good:
        many_g, x_g, xx_g = split(above)
        gap = nodes([c])[:, None] - low
        p = 1 / (1 + np.exp(np.clip(gap, -500, 500)))
        w = p * (1 - p)
        pairs += many_g.sum() * many_b.sum()
        loss += many_g @ np.logaddexp(0, -gap) @ many_b
        slope -= x_g.T @ (p @ many_b) - x_b.T @ (many_g @ p)
        square = xx_g.T @ (w @ many_b) + xx_b.T @ (many_g @ w)
        cross = x_g.T @ w @ x_b
        bend += square.reshape(FEATURES, FEATURES) - cross - cross.T
    ridge = RIDGE * weights
    return loss / pairs + ridge @ weights / 2, slope / pairs + ridge, bend / pairs + RIDGE * np.eye(FEATURES)


def _least(sums_of: Callable[[np.ndarray, np.ndarray], Sums]) -> np.ndarray | None:
    """The weights of least loss. ``sums_of`` gives the sums of features divided
    by a scale, for weights of the scaled features. None without both labels."""
    ones, w = np.ones(FEATURES), np.zeros(FEATURES)
    first = {label: v.sum(axis=0) for (label, _), v in sums_of(w, ones).items()}
    if len(first) < 2:
        return None
    (mean_b, square_b), (mean_g, square_g) = (
        (v[1 : FEATURES + 1] / v[0], np.diag(v[FEATURES + 1 :].reshape(FEATURES, FEATURES)) / v[0])
        for v in (first[0], first[1])
    )
    # Mean square of the differences over all pairs.
    scale = np.sqrt(np.maximum(square_g - 2 * mean_g * mean_b + square_b, 0))
    scale = np.where(scale > 1e-9, scale, 1)
    best, step = np.inf, np.zeros(FEATURES)
    for _ in range(100):
        loss, slope, bend = _derivatives(sums_of(w, scale), w)
        if loss > best + 1e-10:
            step /= 2  # too far
            w = w + step
            continue
        best, step = loss, np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _below(rows: int, share: float) -> int:
    return min(max(round(rows * share), 1), rows - 1)


def _one_label(any_bad: bool) -> Ranking:
    return Ranking(np.zeros(FEATURES), 1.0 if any_bad else 0.0)


def fit(x: np.ndarray, label: np.ndarray, quantile: float | None = None) -> Ranking:
    """Bradley-Terry weights from features and 0/1 labels.

    ``quantile`` is the share of documents to be rejected; by default that of
    label 0. Without both labels there is no pair: the weights are zero and all
    documents get ``CUT`` (the only label is 1, or no labels) or less.
    """
    bad = int((label == 0).sum())
    w = _least(lambda w, scale: node_sums(x / scale, label, w)) if len(label) else None
    if w is None:
        return _one_label(bad > 0)
    strength = np.sort(x @ w)
    below = _below(len(strength), quantile if quantile is not None else bad / len(label))
    return Ranking(w, float(strength[below - 1] + strength[below]) / 2)


def _labelled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
    return x, batch["label"].to_numpy(zero_copy_only=False).astype(np.int64)


def _summed(measured: DataFrame, weights: np.ndarray, scale: np.ndarray) -> Sums:
    """``node_sums`` of all rows: per batch, then per label and cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Sums = {}
        for batch in batches:
            x, label = _labelled(batch)
            for key, value in node_sums(x / scale, label, weights).items() if len(x) else ():
                own[key] = own[key] + value if key in own else value
        part = TaskContext.get().partitionId()
        for (label, cell), value in own.items():
            yield pa.record_batch({"label": [label], "cell": [cell], "part": [part], "sums": [value.ravel()]})

    def add(table: pa.Table) -> pa.Table:
        # In a fixed order, so that a run gives what another gave.
        rows = table.sort_by("part")
        total = sum(rows["sums"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1))
        return pa.table({"label": rows["label"][:1], "cell": rows["cell"][:1], "sums": [total]})

    parts = measured.select("label", "x").mapInArrow(
        run, "label bigint, cell bigint, part bigint, sums array<double>"
    )
    added = parts.groupBy("label", "cell").applyInArrow(add, "label bigint, cell bigint, sums array<double>")
    return {(r.label, r.cell): np.array(r.sums).reshape(NODES, -1) for r in added.collect()}


def _ranked(strengths: DataFrame, rank: int) -> float:
    """The value with so many rows before it in ascending order. Each pass counts
    the rows of equal parts of the range that is left."""
    low, high = strengths.agg(F.min("strength"), F.max("strength")).first()
    place = F.col("strength")
    while low < high:
        part = F.least(F.floor((place - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1))
        found = strengths.where(place.between(low, high)).groupBy(part.alias("part"))
        counts = found.agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
        for r in counts.orderBy("part").collect():
            if rank < r.n:
                low, high = r.low, r.high
                break
            rank -= r.n
    return low


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    label: str = "quality",
) -> Ranking:
    """Fit on all labelled documents.

    Labels other than 0 and 1 and rows without an id are not used; of several
    labels for one id the smaller one counts, of several texts that with the
    smallest features.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col(doc_id).cast("bigint").alias("label_id"))
        .agg(F.min(label).cast("int").alias("label"))
        .where("label_id IS NOT NULL")
    )
    chosen = written(chosen, "labels")
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("label_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            x = pa.array(list(features(part["text"])), pa.list_(pa.float64()))
            yield part.drop_columns(["text"]).append_column("x", x)

    if chosen.count() <= BROADCAST_LABELS:
        held = texts.join(F.broadcast(chosen), "label_id").select("label_id", "label", "text")
        measured = arrow_rows(held, run, "label_id bigint, label int, x array<double>")
    else:
        everything = arrow_rows(texts.where("label_id IS NOT NULL"), run, "label_id bigint, x array<double>")
        measured = everything.join(chosen, "label_id")
    measured = measured.groupBy("label_id", "label").agg(F.min("x").alias("x")).select("label", "x")
    measured = written(measured, "features")
    counts = {r.label: r.n for r in measured.groupBy("label").agg(F.count("*").alias("n")).collect()}
    w = _least(lambda w, scale: _summed(measured, w, scale)) if len(counts) == 2 else None
    if w is None:
        return _one_label(0 in counts)

    def strength(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch({"strength": _labelled(batch)[0] @ w})

    strengths = written(arrow_rows(measured, strength, "strength double"), "strengths")
    rows = sum(counts.values())
    below = _below(rows, counts[0] / rows)
    return Ranking(w, (_ranked(strengths, below - 1) + _ranked(strengths, below)) / 2)


def scored(
    docs: DataFrame, ranking: Ranking, text: str = "text", *, column: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1; null and empty texts score like a text
    without words. A column named ``column`` must not exist yet."""
    name = fresh(docs.columns, "text")
    rows = docs.withColumn(name, F.coalesce(F.col(text).cast("string"), F.lit("")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, name):
            columns = [*part.columns[:-1], pa.array(ranking.scores(part.column(name)))]
            names = [*part.schema.names[:-1], column]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return arrow_rows(rows, run, schema)


def keep_good(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of at least ``CUT``, all columns kept."""
    name = fresh(docs.columns, "score")
    found = scored(docs, ranking, text, column=name)
    return found.where(F.col(name) >= CUT).drop(name)
