"""Ranked lexical search by the Best Position Algorithm.

1. Documents are cut into terms once. Each task gathers up to ``CHUNK_DOCS`` of
   them into one row of the index: the terms' postings (document, count), and
   the documents' ids and lengths. No posting is shuffled. Only terms that an
   item asks for are kept, if the list of those proves small; else all are.
2. Document frequencies, the number of documents and of terms are sums over the
   index. They give each term's weight, which goes with the items.
3. For every chunk each term of an item has an impact list: its documents by
   falling partial score. The lists are read side by side, some places at a
   time. A document met in one list is looked up at once in all others (direct
   access), which marks its places there too. The best position of a list is
   the end of its unbroken run of marked places, often far beyond the place
   read last. No unseen document scores more than the sum of the partial scores
   that come after the best positions: the item is done when this sum is strictly
   below the k-th score, so equal scores are still found.
4. A task takes its k-th scores from chunk to chunk; the best of all tasks are
   ranked per item.

Scores are whole numbers, so the result does not depend on how documents lie.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentia.llm.common import NO_ID, id_or_last, null_if_last
from incidentia.session import written

K = 10
# Share of the length in the saturation of a term's count, in hundredths, and
# its weight against 1000 counts.
LENGTH_SHARE = 75
SATURATION = 8
SCALE = 1_000_000_000

CHUNK_DOCS = 8192
CHUNK_POSTINGS = 1_000_000
# Terms of the items of one block, and bytes of a list that is broadcast.
BLOCK_TERMS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Cells of the partial scores an item needs at a time; a long item takes fewer documents.
CELLS = 4_000_000
# Places read from each list in the first round and at most in one.
FIRST_STEP, MOST_STEP = 8, 256

INDEX = """ids binary, lengths binary, starts binary, places binary, counts binary,
    terms array<binary>, held array<int>, documents bigint, tokens bigint"""
ITEMS = "block int, numbers binary, starts binary, refs binary, times binary, weights binary, terms array<binary>"
FOUND = "item_no bigint, doc_id bigint, score bigint"

# What is no letter, digit or character beyond ASCII parts terms; A-Z become a-z.
_TERM_BYTES = bytes(
    b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(",")]


class Chunk:
    """Postings of some documents, gathered until they make an index row."""

    def __init__(self, wanted: frozenset[bytes] | None):
        self.wanted = wanted
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.refs: list[int] = []
        self.times: list[int] = []
        self.distinct: list[int] = []

    def add(self, doc_id: int, text: bytes | None) -> None:
        terms = terms_of(text)
        counted = Counter(terms)
        if self.wanted is not None:
            counted = {t: n for t, n in counted.items() if t in self.wanted}
        numbers = self.numbers
        self.refs += [numbers.setdefault(t, len(numbers)) for t in counted]
        self.times += counted.values()
        self.distinct.append(len(counted))
        self.ids.append(doc_id)
        self.lengths.append(len(terms))

    def full(self) -> bool:
        return len(self.ids) >= CHUNK_DOCS or len(self.refs) >= CHUNK_POSTINGS

    def row(self) -> pa.RecordBatch:
        refs = np.array(self.refs, dtype=np.int64)
        order = np.argsort(refs, kind="stable")
        places = np.repeat(np.arange(len(self.ids)), self.distinct)
        held = np.bincount(refs, minlength=len(self.numbers))
        starts = np.concatenate([[0], np.cumsum(held)])
        lengths = np.array(self.lengths, dtype=np.int64)
        blobs = [
            np.array(self.ids, dtype="<i8"),
            lengths.astype("<i8"),
            starts.astype("<i8"),
            places[order].astype("<i4"),
            np.array(self.times, dtype="<i8")[order],
        ]
        columns = [pa.array([b.tobytes()], pa.binary()) for b in blobs]
        columns.append(pa.array([list(self.numbers)], pa.list_(pa.binary())))
        columns.append(pa.array([held.tolist()], pa.list_(pa.int32())))
        columns.append(pa.array([int((lengths > 0).sum())], pa.int64()))
        columns.append(pa.array([int(lengths.sum())], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=_names(INDEX))


def index(docs: DataFrame, doc_id: str, text: str, wanted: frozenset[bytes] | None) -> DataFrame:
    """The chunks of ``docs``; with ``wanted`` only postings of those terms."""
    rows = docs.select(
        id_or_last(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    )
    sent = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None if sent is None else sent.value
        chunk = Chunk(kept)
        for batch in batches:
            for number, source in zip(batch["doc_id"].to_pylist(), batch["text"]):
                chunk.add(number, source.as_py())
                if chunk.full():
                    yield chunk.row()
                    chunk = Chunk(kept)
        if chunk.ids:
            yield chunk.row()

    return rows.mapInArrow(run, INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_no, term, times) of the items ``item_no, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, source in zip(batch["item_no"].to_pylist(), batch["text"]):
                counted = Counter(terms_of(source.as_py()))
                columns = [
                    pa.array([number] * len(counted), pa.int64()),
                    pa.array(list(counted), pa.binary()),
                    pa.array(list(counted.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["item_no", "term", "times"])

    rows = items.select("item_no", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_no bigint, term binary, times bigint")


def _packed_items(weighted: DataFrame) -> tuple[DataFrame, int]:
    """Items ``item_no, term, times, weight`` in blocks of about ``BLOCK_TERMS``
    terms, and how many blocks there are."""
    blocks = max(1, math.ceil(weighted.count() / BLOCK_TERMS))
    dealt = weighted.withColumn("block", F.pmod(F.xxhash64("item_no"), F.lit(blocks)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        numbers, begins = np.unique(np.sort(table["item_no"].to_numpy()), return_index=True)
        order = np.argsort(table["item_no"].to_numpy(), kind="stable")
        coded = table["term"].combine_chunks().dictionary_encode()
        starts = np.append(begins, len(order))
        blobs = [numbers, starts, coded.indices.to_numpy()[order]]
        blobs += [table[name].to_numpy()[order] for name in ("times", "weight")]
        columns = [table["block"][:1].combine_chunks()]
        columns += [pa.array([b.astype("<i8").tobytes()], pa.binary()) for b in blobs]
        columns.append(pa.array([coded.dictionary.to_pylist()], pa.list_(pa.binary())))
        return pa.Table.from_arrays(columns, names=_names(ITEMS))

    packed = dealt.groupBy("block").applyInArrow(pack, ITEMS)
    return written(packed, "item-blocks"), blocks


class Lists:
    """The impact lists of a chunk: postings by term and falling partial score."""

    def __init__(self, row: dict, weights: dict[bytes, int], documents: int, tokens: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        lengths = np.frombuffer(row["lengths"], "<i8")
        self.starts = np.frombuffer(row["starts"], "<i8")
        places = np.frombuffer(row["places"], "<i4")
        counts = np.frombuffer(row["counts"], "<i8")
        self.numbers = {t: i for i, t in enumerate(row["terms"])}
        weight = np.array([weights.get(t, 0) for t in row["terms"]], dtype=np.int64)
        norms = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * documents // tokens
        part = SCALE * counts // (1000 * counts + SATURATION * norms[places])
        term = np.repeat(np.arange(len(weight)), np.diff(self.starts))
        impacts = weight[term] * part
        order = np.lexsort((-impacts, term))
        self.places, self.impacts = places[order], impacts[order]

    def list_of(self, term: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        number = self.numbers.get(term)
        if number is None:
            return None
        held = slice(self.starts[number], self.starts[number + 1])
        return self.places[held], self.impacts[held]


class Best:
    """The ``k`` best (score, document) of an item so far, by falling score and rising id."""

    def __init__(self, k: int):
        self.k = k
        self.heap: list[tuple[int, int]] = []

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        reach = scores > 0
        if len(self.heap) == self.k:
            reach &= scores >= self.heap[0][0]
        for score, number in zip(scores[reach].tolist(), ids[reach].tolist()):
            entry = (score, -number)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)

    def done(self, threshold: int) -> bool:
        """No unseen document can be among the best."""
        return threshold <= 0 or len(self.heap) == self.k and threshold < self.heap[0][0]


def search(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, best: Best) -> int:
    """Best Position Algorithm over impact lists (documents, partial scores) of
    the documents ``ids``. Returns how many documents were looked up."""
    many, docs = len(lists), len(ids)
    rows = np.arange(many)[:, None]
    partial = np.zeros((many, docs), dtype=np.int64)
    # Where each document is in each list; the last column stands for nowhere.
    place = np.full((many, docs), docs + 1)
    for i, (held, impacts) in enumerate(lists):
        partial[i, held] = impacts
        place[i, held] = np.arange(len(held))
    marked = np.zeros((many, docs + 2), dtype=bool)
    met = np.zeros(docs, dtype=bool)
    at = [0] * many
    depth, step = 0, FIRST_STEP
    while True:
        read = np.concatenate([held[depth : depth + step] for held, _ in lists])
        new = np.unique(read[~met[read]])
        met[new] = True
        best.offer(partial[:, new].sum(axis=0), ids[new])
        marked[rows, place[:, new]] = True
        threshold = 0
        for i, (held, impacts) in enumerate(lists):
            at[i] += int(marked[i, at[i] : len(held) + 1].argmin())
            if at[i] < len(held):
                threshold += int(impacts[at[i]])
        if best.done(threshold):
            return int(met.sum())
        depth, step = depth + step, min(2 * step, MOST_STEP)


def _item_lists(lists: Lists, terms: list[bytes], times: np.ndarray, best: Best) -> None:
    found = []
    for term, n in zip(terms, times.tolist()):
        held = lists.list_of(term)
        # A weight of zero adds nothing to any score.
        if held is not None and held[1][0] > 0:
            found.append((held[0], held[1] * n))
    if not found:
        return
    most = max(1, CELLS // len(found))
    for begin in range(0, len(lists.ids), most):
        part = found
        if most < len(lists.ids):
            inside = [(p >= begin) & (p < begin + most) for p, _ in found]
            part = [(p[m] - begin, s[m]) for (p, s), m in zip(found, inside) if m.any()]
        if part:
            search(part, lists.ids[begin : begin + most], best)


def _search_chunks(
    chunks: DataFrame, items: DataFrame, blocks: int, documents: int, tokens: int, k: int
) -> DataFrame:
    """(item_no, doc_id, score): the best ``k`` of each task and item."""
    items = items.withColumnsRenamed({n: f"item_{n}" for n in _names(ITEMS) if n != "block"})
    size = items.agg(F.sum(sum(F.length(f"item_{n}") for n in ("numbers", "starts", "refs", "times", "weights"))))
    small = (size.first()[0] or 0) <= BROADCAST_BYTES
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    meeting = chunks.withColumn("block", everywhere).join(
        F.broadcast(items) if small else items.hint("shuffle_merge"), "block"
    )

    def answers(bests: dict[int, Best]) -> pa.RecordBatch:
        made = [(n, -d, s) for n, best in bests.items() for s, d in best.heap]
        columns = list(zip(*made)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_names(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, bests = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch[n][i].as_py() for n in batch.schema.names}
                if row["block"] != block:
                    # Another block of items: what the last one found is told first.
                    yield answers(bests)
                    block, bests = row["block"], {}
                terms = row["item_terms"]
                refs, starts, times, weights, numbers = (
                    np.frombuffer(row[f"item_{n}"], "<i8")
                    for n in ("refs", "starts", "times", "weights", "numbers")
                )
                weight = dict(zip((terms[r] for r in refs.tolist()), weights.tolist()))
                lists = Lists(row, weight, documents, tokens)
                for number, a, b in zip(numbers.tolist(), starts[:-1], starts[1:]):
                    own = [terms[r] for r in refs[a:b].tolist()]
                    _item_lists(lists, own, times[a:b], bests.setdefault(number, Best(k)))
        yield answers(bests)

    return meeting.mapInArrow(run, FOUND)


def weight_of(documents: int, held: Column) -> Column:
    """A term's weight from the number of documents that hold it."""
    share = F.lit(2.0 * documents + 2) / (2 * held + 1).cast("double")
    return F.floor(F.lit(1000.0) * F.log(share)).cast("bigint")


def rank(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = K,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with
    a score above 0, best first, equal ones by rising id; fewer if there are no more.

    Every row of ``docs`` is a document: repeated rows count and are ranked one
    by one, those without an id come last among equals. Null and empty texts
    hold no term; such documents do not count, such items have no result. Texts
    are taken whole. Items that agree in id and text are one; different texts
    under one id are ranked apart. Empty tables give an empty table. Other
    columns are not read, so their names do not matter.
    """
    asked = items.select(
        F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")
    ).distinct()
    asked = written(asked.withColumn("item_no", F.monotonically_increasing_id()), "items")
    terms = written(item_terms(asked), "item-terms")
    listed = terms.select("term").distinct()
    # Python keeps some 100 bytes beside those of a term.
    size = listed.agg(F.sum(F.length("term") + 100)).first()[0] or 0
    wanted = frozenset(bytes(r[0]) for r in listed.collect()) if size <= BROADCAST_BYTES else None
    chunks = written(index(docs, doc_id, text, wanted), "lexical-index")

    documents, tokens = chunks.agg(F.sum("documents"), F.sum("tokens")).first()
    entries = chunks.select(F.explode(F.arrays_zip("terms", "held")).alias("entry"))
    held = entries.groupBy(F.col("entry.terms").alias("term")).agg(F.sum("entry.held").alias("held"))
    weighted = terms.join(held, "term").select(
        "item_no", "term", "times", weight_of(documents or 0, F.col("held")).alias("weight")
    )
    packed, blocks = _packed_items(weighted)
    found = _search_chunks(chunks, packed, blocks, documents or 0, tokens or 1, k)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item_no", "item_id"), "item_no").select(
        "item_id",
        F.col("rank").cast("int").alias("rank"),
        null_if_last(F.col("doc_id")).alias("doc_id"),
        "score",
    )
