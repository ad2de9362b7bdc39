"""Benchmark decontamination by spaced seeds.

A spaced seed looks at some words of a short span and ignores the others, so
it also finds places where single words were replaced. The three masks below
have a hit in every window of 8 to 13 words of which four fifths agree (a test
tries all cases). An item of fewer words has one seed, the hash of all of it.

Both sides are tables of seed hashes, and a hash join brings them together. A
row carries the words around its seed, so a hit is verified where it is found:
a document is contaminated by an item if some window of ``WINDOW`` words (or
the whole item, if shorter) agrees in at least ``AGREEMENT`` of its places; an
item below ``LEAST_WORDS`` words must agree in all of them. Such a window has a
seed inside it, so looking at the windows around the seeds misses none.

A Bloom filter of the benchmark's seeds, of at most ``2 ** FILTER_BITS`` bits,
keeps other seeds of the documents out of the join. It only saves work: a
fuller one lets more rows pass and changes no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import SLICE_ROWS, arrow_rows, fresh, spread_join
from incidentia.llm.tokens import slices
from incidentia.llm.words import bare_words
from incidentia.session import written

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
WINDOW = 13
AGREEMENT = 0.8
# Items with fewer words must agree in every word.
LEAST_WORDS = 8
# Removal asks for items of this many words at least: a shorter one is in many clean texts.
EVIDENCE_WORDS = 5
# 32 MB; a smaller benchmark has 64 bits for each of its seeds, of which each sets four.
FILTER_BITS = 28
PROBES = 4
# Bits of one row of the filter, fixed by the aggregate that makes it.
BUCKET_BITS = 15
# Words before and after the begin of a seed that a window around it can reach.
BEFORE = WINDOW - 1 - min(m[-1] for m in MASKS)
AFTER = WINDOW
# Text that is cut into words at a time, and seeds whose surroundings are looked up at a time.
TEXT_BYTES = 4 << 20
SEED_ROWS = 20_000
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(8)], np.uint64)
SEEDS = "seed bigint, before int, after int, around binary"


def _word_marks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word, and the place of each text's first word."""
    words, codes, edges = bare_words(texts)
    marks = np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], np.uint64)
    return marks[codes] if len(codes) else np.zeros(0, np.uint64), edges


def _masks(short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """(number of words of a whole item or 0, mask): the spaced masks, then one
    for all words of an item of each short length."""
    return [*((0, m) for m in MASKS), *((n, tuple(range(n))) for n in short)]


def _seeds(
    marks: np.ndarray, edges: np.ndarray, whole: int, mask: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """(seed hash, place) for each place where ``mask`` fits into its text."""
    span = mask[-1] + 1
    size = len(marks) - span + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(size, whole << 8 | sum(1 << m for m in mask), np.uint64)
    for factor, offset in zip(_FACTORS, mask):
        out += marks[offset : offset + size] * factor
    out ^= out >> np.uint64(29)
    out *= _FACTORS[-1]
    fits = np.ones(size, bool)
    for edge in edges[1:-1]:
        fits[max(0, edge - span + 1) : edge] = False
    places = np.flatnonzero(fits)
    return out[places], places


def _around(marks: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> dict:
    """The words around each place, as far as its text (``low`` to ``high``) goes."""
    before = np.minimum(place - low, BEFORE)
    after = np.minimum(high - place, AFTER)
    steps = np.arange(-BEFORE, AFTER)
    inside = (steps >= -before[:, None]) & (steps < after[:, None])
    at = np.where(inside, place[:, None] + steps, 0)
    return {
        "before": before.astype(np.int32),
        "after": after.astype(np.int32),
        "words": np.where(inside, marks[at], np.uint64(0)),
    }


def _binary(words: np.ndarray) -> pa.Array:
    width = words.shape[1] * 8
    data = np.ascontiguousarray(words, "<u8")
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(words), [None, pa.py_buffer(data)]
    ).cast(pa.binary())


def _numbers(rows: pa.Array) -> np.ndarray:
    """The words of rows of equal width, one row each."""
    if not len(rows):
        return np.zeros((0, BEFORE + AFTER), np.uint64)
    return np.frombuffer(b"".join(rows.to_pylist()), "<u8").reshape(len(rows), -1)


def item_seeds(benchmark: DataFrame, item_id: str, text: str, least_words: int) -> DataFrame:
    """(seed, before, after, around, item_id, words): seeds of all items of at
    least ``least_words`` words."""
    items = benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text")
    ).distinct()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows in slices(batch, most=TEXT_BYTES):
            marks, edges = _word_marks(rows["text"])
            length = np.diff(edges)
            for whole, mask in _masks(list(range(1, LEAST_WORDS))):
                seeds, place = _seeds(marks, edges, whole, mask)
                owner = np.searchsorted(edges, place, "right") - 1
                own = length[owner]
                fit = own == whole if whole else own >= LEAST_WORDS
                fit &= own >= least_words
                owner, place = owner[fit], place[fit]
                around = _around(marks, edges[owner], edges[owner + 1], place)
                yield pa.record_batch(
                    {
                        "seed": seeds[fit].view(np.int64),
                        "before": around["before"],
                        "after": around["after"],
                        "around": _binary(around["words"]),
                        "item_id": rows["item_id"].take(pa.array(owner)),
                        "words": length[owner].astype(np.int32),
                    }
                )

    made = arrow_rows(items, run, SEEDS + ", item_id bigint, words int")
    return written(made, "benchmark-seeds")


class SeedFilter:
    """A Bloom filter of the seeds of a benchmark."""

    def __init__(self, seeds: DataFrame):
        count = seeds.count()
        self.bits = min(FILTER_BITS, max(BUCKET_BITS, math.ceil(math.log2(64 * count + 1))))

        def probe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            own = batch["seed"].to_numpy().view(np.uint64)
            places = np.concatenate([self.probe(own, i) for i in range(PROBES)])
            yield pa.record_batch({"place": places.view(np.int64)})

        places = arrow_rows(seeds.select("seed").distinct(), probe, "place bigint")
        bucket = F.shiftright("place", BUCKET_BITS).cast("int").alias("bucket")
        bit = F.col("place").bitwiseAND((1 << BUCKET_BITS) - 1)
        rows = places.groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias("bits"))
        self.bytes = np.zeros((1 << (self.bits - BUCKET_BITS), 1 << (BUCKET_BITS - 3)), np.uint8)
        # At most 2 ** (FILTER_BITS - BUCKET_BITS) rows of 4 KB, whatever the benchmark's size.
        for row in rows.collect():
            self.bytes[row.bucket] = np.frombuffer(row.bits, np.uint8)
        self.bytes = self.bytes.reshape(-1)

    def probe(self, seeds: np.ndarray, number: int) -> np.ndarray:
        return (seeds * _FACTORS[number]) >> np.uint64(64 - self.bits)

    def places(self, seeds: np.ndarray) -> np.ndarray:
        """Places of the seeds that may be in the benchmark."""
        left = np.arange(len(seeds))
        for number in range(PROBES):
            at = self.probe(seeds[left], number)
            bit = (at & np.uint64(7)).astype(np.uint8)
            left = left[(self.bytes[at >> np.uint64(3)] >> bit) & 1 == 1]
        return left


def text_seeds(rows: DataFrame, known: SeedFilter, short: list[int]) -> DataFrame:
    """(seed, before, after, around, doc_id, mark, row, place): the seeds of all
    documents that pass the filter. Of equal rows of a document the first is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A number of its own for each row: task and place in the task.
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for texts in slices(batch, most=TEXT_BYTES):
                marks, edges = _word_marks(texts["text"])
                for whole, mask in _masks(short):
                    seeds, place = _seeds(marks, edges, whole, mask)
                    maybe = known.places(seeds)
                    seeds, place = seeds[maybe], place[maybe]
                    for at in range(0, len(seeds), SEED_ROWS):
                        yield found(
                            texts, marks, edges, whole, number,
                            seeds[at : at + SEED_ROWS], place[at : at + SEED_ROWS],
                        )
                number += len(texts)

    def found(texts, marks, edges, whole, number, seeds, place) -> pa.RecordBatch:
        owner = np.searchsorted(edges, place, "right") - 1
        around = _around(marks, edges[owner], edges[owner + 1], place)
        if whole:
            # The seed stands for all words of the item; nothing beside it counts.
            around["words"][:, :BEFORE] = 0
            around["words"][:, BEFORE + whole :] = 0
            around["before"][:] = 0
            around["after"][:] = whole
        key = np.column_stack(
            [owner.astype(np.uint64), around["before"].astype(np.uint64), around["words"]]
        )
        key = np.ascontiguousarray(key).view(f"V{key.shape[1] * 8}").reshape(-1)
        first = np.sort(np.unique(key, return_index=True)[1])
        owner = owner[first]
        return pa.record_batch(
            {
                "seed": seeds[first].view(np.int64),
                "before": around["before"][first],
                "after": around["after"][first],
                "around": _binary(around["words"][first]),
                "doc_id": texts["doc_id"].take(pa.array(owner)),
                "mark": texts["mark"].take(pa.array(owner)),
                "row": pa.array(number + owner),
                "place": pa.array(place[first] - edges[owner]),
            }
        )

    schema = SEEDS + ", doc_id bigint, mark binary, row bigint, place bigint"
    return rows.mapInArrow(run, schema)


def best_windows(
    ours: np.ndarray, theirs: np.ndarray, before: np.ndarray, after: np.ndarray, words: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(agreeing words, words of the window, its begin before or after the seed)
    of the best window of each row, the first of equal ones; -1 agreeing words
    if none fits into both texts."""
    same = np.zeros((len(ours), BEFORE + AFTER + 1), np.int32)
    np.cumsum(ours == theirs, axis=1, out=same[:, 1:])
    window = np.minimum(WINDOW, words)
    best, place = np.full(len(ours), -1, np.int32), np.zeros(len(ours), np.int64)
    for size in np.unique(window):
        rows = np.flatnonzero(window == size)
        sums = same[rows, size:] - same[rows, : BEFORE + AFTER + 1 - size]
        begin = np.arange(sums.shape[1]) - BEFORE
        sums[(begin < -before[rows, None]) | (begin + size > after[rows, None])] = -1
        at = sums.argmax(axis=1)
        best[rows] = sums[np.arange(len(rows)), at]
        place[rows] = begin[at]
    return best, window, place


def _verify(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = batch["words"].to_numpy()
    before = np.minimum(batch["before"].to_numpy(), batch["item_before"].to_numpy())
    after = np.minimum(batch["after"].to_numpy(), batch["item_after"].to_numpy())
    same, window, begin = best_windows(
        _numbers(batch["around"]), _numbers(batch["item_around"]), before, after, words
    )
    need = np.where(words < LEAST_WORDS, window, np.ceil(AGREEMENT * window))
    kept = pa.array(np.flatnonzero(same >= need))
    made = {
        "doc_id": batch["doc_id"],
        "mark": batch["mark"],
        "row": batch["row"],
        "item_id": batch["item_id"],
        "agreeing": pa.array(same, pa.int32()),
        "window": pa.array(window.astype(np.int32)),
        "first_word": pa.array(batch["place"].to_numpy() + begin),
    }
    yield pa.record_batch(made).take(kept)


HITS = (
    "doc_id bigint, mark binary, row bigint, item_id bigint, agreeing int, window int, first_word bigint"
)


def _hits(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, least: int) -> DataFrame:
    """A row for each seed of a document (doc_id, mark, text) around which a
    window agrees with an item."""
    items = item_seeds(benchmark, item_id, item_text, least)
    lengths = items.where(F.col("words") < LEAST_WORDS).select("words").distinct()
    short = sorted(r.words for r in lengths.collect())
    seeds = written(text_seeds(rows, SeedFilter(items), short), "document-seeds")
    # A seed of many documents is dealt over several tasks, its items are copied to each.
    # The list holds at most (all rows / SLICE_ROWS) seeds.
    counts = seeds.groupBy("seed").count().where(F.col("count") > SLICE_ROWS)
    pieces = F.ceil(F.col("count") / F.lit(SLICE_ROWS)).cast("int").alias("pieces")
    many = F.broadcast(written(counts.select("seed", pieces), "frequent-seeds"))
    piece = F.coalesce(F.pmod(F.xxhash64("row", "place"), "pieces").cast("int"), F.lit(0))
    ours = seeds.join(many, "seed", "left").withColumn("piece", piece).drop("pieces")
    last = F.coalesce("pieces", F.lit(1)) - 1
    theirs = items.join(many, "seed", "left").select(
        "seed",
        F.explode(F.sequence(F.lit(0), last)).alias("piece"),
        "item_id",
        "words",
        *(F.col(c).alias(f"item_{c}") for c in ("before", "after", "around")),
    )
    return arrow_rows(ours.join(theirs, ["seed", "piece"]), _verify, HITS)


def _text_mark(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = 1,
) -> DataFrame:
    """(doc_id, item_id, agreeing, window, first_word): one row for each document
    row and benchmark item that overlap, with the best window (ties: the first).

    Null and empty texts overlap with nothing, nor do items of fewer than
    ``least_words`` words. Missing document and item ids are null; texts of one
    item id, or without an id, count as one item. Repeated documents are
    reported each; repeated items once. With an empty table on either side the
    result is empty.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.lit(b"").alias("mark"),
    )
    hits = _hits(rows, benchmark, item_id, item_text, least_words)
    better = F.struct("agreeing", (-F.col("first_word")).alias("early"), "window", "doc_id")
    best = hits.groupBy("row", "item_id").agg(F.max(better).alias("best"))
    return best.select(
        F.col("best.doc_id").alias("doc_id"),
        "item_id",
        F.col("best.agreeing").alias("agreeing"),
        F.col("best.window").alias("window"),
        (-F.col("best.early")).alias("first_word"),
    )


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = EVIDENCE_WORDS,
) -> DataFrame:
    """Rows of ``docs`` that overlap with no benchmark item of at least
    ``least_words`` words, all columns kept.

    The decision depends on the text alone: of rows with equal texts all stay
    or all go, whatever their ids. Null and empty texts stay. An empty
    benchmark removes nothing.
    """
    mark, n = fresh(docs.columns, "mark"), fresh(docs.columns, "n")
    content = F.col(text).cast("string")
    rows = docs.select(
        F.lit(None).cast("bigint").alias("doc_id"),
        content.alias("text"),
        _text_mark(content).alias("mark"),
    )
    hits = _hits(rows, benchmark, item_id, item_text, least_words)
    found = hits.select("mark", "row").distinct().groupBy("mark").count()
    bad = written(found.select(F.col("mark").alias(mark), F.col("count").alias(n)), "contaminated")
    marked = docs.withColumn(mark, _text_mark(content))
    # Any deal will do: every slice gets all marks.
    by = F.monotonically_increasing_id()
    return spread_join(marked, bad, [mark], by, count=n, how="left_anti").drop(mark)
