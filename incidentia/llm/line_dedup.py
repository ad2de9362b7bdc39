"""Removal of repeated passages by content-defined chunks of lines.

1. A text is cut into lines; blank lines belong to the line before them. A line
   of ``PARAGRAPH_WORDS`` words or more with several sentences is a paragraph:
   it is a block by itself, and its sentences are the lines of that block. So is
   a line of more than ``LONE_LINE_WORDS`` words. Other lines that follow each
   other are one block.
2. In each block a hash rolls over the hashes of the last ``WINDOW`` lines; where
   it falls on one value out of ``DIVISOR`` and the lines so far can be counted,
   a chunk ends. What is left at the end and too short joins the chunk before it.
   No place depends on another block.
3. Chunks of at least two lines and ``CHUNK_WORDS`` words (or of one line of
   more than ``LONE_LINE_WORDS``) are counted over all documents by 128-bit keys,
   and those with equal keys are compared byte by byte; so are neighbouring whole lines, two by two where they have
   ``PARAGRAPH_WORDS`` words together, as a passage may begin and end anywhere
   among them.
4. The first occurrence of a chunk or pair stays (smallest document id, then
   first place); the others go. All other text stays byte for byte.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incidentia.llm.common import (
    arrow_rows,
    drop_written,
    free_shuffles,
    fresh,
    id_or_last,
    spread_join,
    written_tight,
)
from incidentia.session import written

PARAGRAPH_WORDS = 20
WINDOW = 2
DIVISOR = 2
CHUNK_WORDS = 12
LONE_LINE_WORDS = 50
SLICE_TEXTS = 1000
# What ``bytes.strip`` takes off.
BLANKS = " \t\n\r\x0b\x0c"
BASE = 0x9E3779B1
MASK = (1 << 64) - 1
LEAVES = pow(BASE, WINDOW, 1 << 64)

_SENTENCE = re.compile(rb"[.!?]+[ \t]+")
_BREAK = re.compile(rb"\n(?:[ \t\r]*\n)*")

# (start, end, words)
Line = tuple[int, int, int]


def _blocks(text: bytes) -> Iterator[tuple[list[Line], bool]]:
    """The lines of each block, and whether they are whole lines."""
    whole: list[Line] = []
    start = 0
    while start < len(text):
        found = _BREAK.search(text, start)
        end = found.end() if found else len(text)
        words = len(text[start:end].split())
        cuts = []
        if words >= PARAGRAPH_WORDS:
            cuts = [m.end() for m in _SENTENCE.finditer(text, start, end) if text[m.end() : end].strip()]
        if cuts or words > LONE_LINE_WORDS:
            if whole:
                yield whole, True
                whole = []
            edges = [start, *cuts, end]
            yield [(a, b, len(text[a:b].split())) for a, b in zip(edges, edges[1:])], False
        else:
            whole.append((start, end, words))
        start = end
    if whole:
        yield whole, True


def _cut(text: bytes, block: list[Line]) -> list[tuple[int, int, bool]]:
    """(start, end, counted) of the chunks of a block."""
    out: list[tuple[int, int, bool]] = []
    recent = deque([0] * WINDOW)
    rolled = lines = words = 0
    begin = block[0][0]
    for start, end, n in block:
        lines, words = lines + 1, words + n
        mark = xxhash.xxh64_intdigest(text[start:end].strip())
        # The line that leaves the window goes, the new one comes.
        rolled = (rolled * BASE + mark - recent.popleft() * LEAVES) & MASK
        recent.append(mark)
        if (rolled >> 32) % DIVISOR == 0 and _counted(lines, words):
            out.append((begin, end, True))
            begin, lines, words = end, 0, 0
    if lines:
        if out and not _counted(lines, words):
            begin = out.pop()[0]
            out.append((begin, end, True))
        else:
            out.append((begin, end, _counted(lines, words)))
    return out


def _counted(lines: int, words: int) -> bool:
    return words > LONE_LINE_WORDS or lines > 1 and words >= CHUNK_WORDS


def chunks(text: bytes) -> Iterator[tuple[int, int, bool]]:
    """(start, end, counted) of the chunks, which together make up the text."""
    for block, _ in _blocks(text):
        yield from _cut(text, block)


def units(text: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of what is counted: chunks, and pairs of whole lines."""
    for block, whole in _blocks(text):
        own = [(a, b) for a, b, counted in _cut(text, block) if counted]
        if whole:
            own += [(x[0], y[1]) for x, y in zip(block, block[1:]) if x[2] + y[2] >= PARAGRAPH_WORDS]
        yield from sorted(set(own))


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def placed(source: bytes) -> tuple[list[tuple[int, int]], list[tuple[int, int, bytes, bool]]]:
    """(start, end) of the units that an earlier place of the same text has, and
    (start, end, unit, is it the first place?) of all others.

    A unit that overlaps its own first place is among the others, so that place
    stays whole.
    """
    ends: dict[bytes, int] = {}
    repeats, others = [], []
    for a, b in units(source):
        unit = source[a:b].strip()
        first = unit not in ends
        if ends.setdefault(unit, b) <= a:
            repeats.append((a, b))
        else:
            others.append((a, b, unit, first))
    return repeats, others


def without(source: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, which may overlap."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            out.append(source[at:a])
        at = max(at, b)
    out.append(source[at:])
    return b"".join(out)


UNIT = "array<struct<begin: int, until: int, key: bigint, rest: bigint, first: boolean>>"
SPANS = "array<struct<begin: int, until: int>>"


def _lists(counts: list[int], **columns: np.ndarray) -> pa.ListArray:
    fields = [pa.array(v) for v in columns.values()]
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=list(columns)))


def cut_rows(docs: DataFrame, text: str, row: str, unit: str, repeat: str) -> DataFrame:
    """``docs`` with a number of its own for each row, its units with their places
    and 128-bit keys, and the spans that repeat an earlier place of the same text.

    The table is written, so a row keeps its number.
    """
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # Small slices, so that the places of few texts are held at a time.
        for begin in range(0, batch.num_rows, SLICE_TEXTS):
            yield cut(batch.slice(begin, SLICE_TEXTS))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, keys, firsts, many = [], [], [], []
        repeats, few = [], []
        for t in batch[at].to_pylist():
            source = _encoded(t)
            own, others = placed(source)
            repeats += own
            few.append(len(own))
            for a, b, held, first in others:
                places.append((a, b))
                firsts.append(first)
                keys.append(xxhash.xxh3_128_digest(held))
            many.append(len(others))
        where = np.array(places, dtype=np.int32).reshape(-1, 2).T
        key = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2).T
        names = ("begin", "until", "key", "rest", "first")
        found = _lists(many, **dict(zip(names, [*where, *key, np.array(firsts, dtype=bool)])))
        spans = np.array(repeats, dtype=np.int32).reshape(-1, 2).T
        own_spans = _lists(few, begin=spans[0], until=spans[1])
        return pa.RecordBatch.from_arrays(
            [*batch.columns, found, own_spans], names=[*batch.schema.names, unit, repeat]
        )

    added = StructType.fromDDL(f"`{unit}` {UNIT}, `{repeat}` {SPANS}")
    schema = StructType([*numbered.schema.fields, *added.fields])
    return written_tight(arrow_rows(numbered, run, schema), "cut-texts")


def repeated_units(cut: DataFrame, doc_id: str, row: str, unit: str) -> DataFrame:
    """(key, rest, n, holder): keys of units that more than one row holds, the
    number of rows, and the row that comes first (smallest document id, rows
    without one last, then the row's number)."""
    place = F.struct(id_or_last(doc_id).alias("doc_id"), F.col(row).alias("row"))
    each = cut.select(place.alias("place"), F.inline(unit)).where("first")
    counted = each.groupBy("key", "rest").agg(F.count("*").alias("n"), F.min("place").alias("place"))
    return counted.where("n > 1").select("key", "rest", "n", F.col("place.row").alias("holder"))


def _marks(cut: DataFrame, repeated: DataFrame, row: str, unit: str) -> DataFrame:
    """(row, marks): for each row its units that other rows hold too."""
    own = cut.select(F.col(row).alias("row"), F.inline(unit)).drop("first")
    found = spread_join(own, repeated, ["key", "rest"], F.xxhash64("row", "begin"))
    mark = F.struct("begin", "until", "key", "rest", (F.col("row") != F.col("holder")).alias("goes"))
    return found.groupBy("row").agg(F.collect_list(mark).alias("marks"))


def clashing_keys(marked: DataFrame, text: str, marks: str) -> DataFrame:
    """(key, rest) of repeated units whose bytes are not all the same."""
    held = F.substring(F.col("source"), F.col("begin") + 1, F.col("until") - F.col("begin"))
    chunk = F.btrim(held.cast("string"), F.lit(BLANKS))
    each = marked.select(F.encode(F.col(text), "UTF-8").alias("source"), F.inline(marks))
    by_bytes = each.select("key", "rest", chunk.alias("chunk")).distinct()
    return by_bytes.groupBy("key", "rest").agg(F.count("*").alias("texts")).where("texts > 1").select("key", "rest")


def remove_repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None
) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``; same rows and columns.

    ``length`` names a column that holds the length of the text; it is set
    anew where a text changed. Null texts stay null, empty ones empty; a text
    of which every chunk is repeated becomes empty. Each row is a document of
    its own, also where ids are missing or repeated: rows without an id come
    after all others, and of rows with one id the first that is read comes
    first. Line breaks and blanks around a removed chunk go with it. An empty
    table gives an empty table.

    Texts are cut once, into a written table. Only keys and places are counted
    and joined. The bytes of units whose key occurs more than once are then
    compared; should two different units share a 128-bit key, neither goes.
    """
    names = [*docs.columns]
    row, unit, repeat, marks = (fresh(names, n) for n in ("row_no", "units", "repeats", "marks"))
    cut = cut_rows(docs, text, row, unit, repeat)
    repeated = written(repeated_units(cut, doc_id, row, unit), "repeated-units")
    free_shuffles(docs.sparkSession)
    own = written(_marks(cut, repeated, row, unit).toDF(row, marks), "unit-marks")
    free_shuffles(docs.sparkSession)
    marked = written_tight(cut.drop(unit).join(own, row, "left"), "marked-texts")
    drop_written(cut)
    clashes = clashing_keys(marked, text, marks)
    if not clashes.isEmpty():
        each = marked.select(row, F.inline(marks)).join(clashes, ["key", "rest"], "left_anti")
        mark = F.struct("begin", "until", "key", "rest", "goes")
        single = each.groupBy(row).agg(F.collect_list(mark).alias(marks))
        marked = written_tight(marked.drop(marks).join(single, row, "left"), "marked-texts")
    goes = F.filter(F.coalesce(marks, F.array()), lambda m: m["goes"])
    bounds = F.transform(goes, lambda m: F.struct(m["begin"].alias("begin"), m["until"].alias("until")))
    spans = marked.select(*names, F.concat(repeat, bounds).alias(marks))
    at, last = names.index(text), len(names)
    lengths = None if length is None else names.index(length)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = batch.columns[:last]
        shorter = np.flatnonzero(pc.list_value_length(batch[last]).to_numpy(zero_copy_only=False))
        texts = columns[at].to_pylist()
        new = None if lengths is None else columns[lengths].to_pylist()
        for i in shorter.tolist():
            gone = [(s["begin"], s["until"]) for s in batch[last][i].as_py()]
            texts[i] = without(_encoded(texts[i]), gone).decode("utf-8", "surrogatepass")
            if new is not None:
                new[i] = len(texts[i])
        columns[at] = pa.array(texts, columns[at].type)
        if new is not None:
            columns[lengths] = pa.array(new, columns[lengths].type)
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:last]))

    return arrow_rows(spans, run, docs.schema)


def removed_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept_chars, removed_chars, kept_md5): what ``remove_repeated`` did
    to each row."""
    before = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("bigint").alias("chars"),
    )
    kept = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    return remove_repeated(before).select(
        "doc_id",
        kept.alias("kept_chars"),
        (F.col("chars") - kept).alias("removed_chars"),
        F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"),
    )
