"""Token shards in training order.

Documents are tokenised and laid end to end in one stream, which is cut into
sequences of a fixed number of ids. A keyed Feistel permutation with
cycle-walking gives each sequence its slot in the training order: it needs no
table of the permutation, and any slot can be turned back into its sequence.
Each range of slots is one file in which record ``i`` begins at byte
``i * stride``, so a reader that stopped at a slot goes on at that byte.

A record is ``size`` little-endian 16-bit ids; the last one is always the end
id 0, which the writer sets as the mark between records. The last sequence is
filled up with end ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentia.llm.common import arrow_rows, few_texts
from incidentia.llm.tokens import ENCODE_BYTES, WordEncoder, largest_id, slices
from incidentia.session import scratch_path, written

SIZE = 2048
END = 0
SHARD_RECORDS = 4096
# Records that a task holds at a time.
BATCH_RECORDS = 256
# Ids are kept and shuffled as zstd frames of this level.
PACK_LEVEL = 3
SPAN = "slot bigint, sequence bigint, offset int, doc_id bigint, start bigint, length bigint"
KEY = 20_240_229
ROUNDS = 6


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of the numbers below ``count``.

    Feistel rounds permute the numbers of ``2 * half`` bits, fewer than
    ``4 * count``; a result outside goes through the rounds again until it
    falls inside.
    """

    count: int
    key: int

    @property
    def half(self) -> int:
        return max(1, -(-max(1, self.count - 1).bit_length() // 2))

    def _mix(self, value: np.ndarray, number: int) -> np.ndarray:
        salt = (self.key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) & (1 << 64) - 1
        x = value + np.uint64(salt)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _rounds(self, value: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = value >> half, value & np.uint64((1 << self.half) - 1)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._mix(left, number), left
            else:
                left, right = right, left ^ self._mix(right, number)
        return left << half | right

    def _walk(self, value: np.ndarray, back: bool) -> np.ndarray:
        out = self._rounds(np.asarray(value, np.uint64), back)
        outside = np.flatnonzero(out >= self.count)
        while len(outside):
            out[outside] = self._rounds(out[outside], back)
            outside = outside[out[outside] >= self.count]
        return out.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, back=False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, back=True)


def _tokenised(docs: DataFrame, tokenizer: str, doc_id: str, text: str) -> DataFrame:
    """(doc_id, part, at, n, ids): ids of each row and its place in the stream
    of the task ``part``; ``ids`` is compressed. To be written once before use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = WordEncoder(tokenizer), TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(PACK_LEVEL)
        for batch in batches:
            for rows in slices(batch, most=ENCODE_BYTES):
                ids, edges = encoder.encode(rows["text"])
                own = [
                    np.append(ids[a:b], np.uint32(END)).astype("<u2")
                    for a, b in zip(edges, edges[1:])
                ]
                n = np.array([len(o) for o in own])
                yield pa.record_batch(
                    {
                        "doc_id": rows["doc_id"],
                        "part": pa.array(np.full(len(own), part, np.int32)),
                        "at": pa.array(at + np.cumsum(n) - n),
                        "n": pa.array(n),
                        "ids": pa.array([pack.compress(o.tobytes()) for o in own], pa.binary()),
                    }
                )
                at += int(n.sum())
            # The worker lives on; what encoding took goes back to the machine.
            pa.default_memory_pool().release_unused()

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, part int, at bigint, n bigint, ids binary")


def _spans(
    tokenised: DataFrame, room: int, permutation: Permutation, bases: DataFrame, *, with_ids: bool
) -> DataFrame:
    """(slot, sequence, offset, doc_id, start, length[, ids]): the documents cut at the
    sequences; ``ids`` is compressed."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        begin, n = (batch[c].to_numpy() for c in ("begin", "n"))
        first = begin // room
        many = (begin + n - 1) // room - first + 1
        row = np.repeat(np.arange(len(n)), many)
        sequence = first[row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
        low = np.maximum(begin[row], sequence * room)
        high = np.minimum((begin + n)[row], (sequence + 1) * room)
        start, length = low - begin[row], high - low
        spans = pa.record_batch(
            {
                "slot": pa.array(permutation.slot(sequence)),
                "sequence": pa.array(sequence),
                "offset": pa.array((low - sequence * room).astype(np.int32)),
                "doc_id": batch["doc_id"].take(pa.array(row)),
                "start": pa.array(start),
                "length": pa.array(length),
            }
        )
        if not with_ids:
            yield spans
            return
        pack, unpack = zstandard.ZstdCompressor(PACK_LEVEL), zstandard.ZstdDecompressor()
        now, ids = -1, b""
        for at in range(0, len(row), BATCH_RECORDS):
            part, cells = spans.slice(at, BATCH_RECORDS), []
            for i in range(at, at + part.num_rows):
                if row[i] != now:
                    now, ids = row[i], unpack.decompress(batch["ids"][row[i]].as_py())
                cells.append(pack.compress(ids[2 * start[i] : 2 * (start[i] + length[i])]))
            yield part.append_column("ids", pa.array(cells, pa.binary()))

    placed = tokenised.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("begin"), "n", *["ids"] * with_ids
    )
    return arrow_rows(placed, run, SPAN + ", ids binary" * with_ids)


@dataclass(frozen=True)
class Shards:
    """Where shards are, and how to find a slot in them."""

    path: str
    records: int
    size: int
    count: int
    permutation: Permutation
    spans: DataFrame

    @property
    def stride(self) -> int:
        return 2 * self.size


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    size: int = SIZE,
    records: int = SHARD_RECORDS,
    key: int = KEY,
) -> Shards:
    """Write the shards below ``path``; file ``i`` holds the slots from ``i * records`` on.

    Null and empty texts are an end id alone. Rows without an id and repeated
    rows are laid out like any other. No documents give no files. A tokenizer
    with ids that 16 bits do not hold is refused.
    """
    if largest_id(tokenizer) >= 1 << 16:
        raise ValueError(f"{tokenizer}: ids above 65,535 do not fit into 16 bits")
    spark, room = docs.sparkSession, size - 1
    with few_texts(spark):
        tokenised = written(_tokenised(docs, tokenizer, doc_id, text), "token-ids")
    parts = written(tokenised.groupBy("part").agg(F.sum("n").alias("tokens")), "token-counts")
    # One row per task of the scan.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    total = parts.agg(F.sum("tokens")).first()[0] or 0
    count = -(-total // room)
    permutation = Permutation(count, key)
    spans = _spans(tokenised, room, permutation, bases, with_ids=False)
    shards = Shards(path, records, size, count, permutation, spans)
    if not count:
        return shards

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, unpack = None, [], zstandard.ZstdDecompressor()

        def record() -> str:
            data = b"".join(held)
            # One id less: the mark between records is the last one.
            return data + bytes(2 * room - len(data))

        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_RECORDS):
                rows, out = batch.slice(begin, BATCH_RECORDS), []
                for slot, ids in zip(rows["slot"].to_pylist(), rows["ids"].to_pylist()):
                    if slot != now and held:
                        out.append(record())
                        held = []
                    now = slot
                    held.append(unpack.decompress(ids))
                yield pa.record_batch({"record": pa.array(out, pa.binary())})
        if held:
            yield pa.record_batch({"record": pa.array([record()], pa.binary())})

    with few_texts(spark):
        (
            _spans(tokenised, room, permutation, bases, with_ids=True)
            .select("slot", "offset", "ids")
            .repartitionById(-(-count // records), F.floor(F.col("slot") / records).cast("int"))
            .sortWithinPartitions("slot", "offset")
            .mapInArrow(assemble, "record binary")
            .select(F.col("record").cast("string"))
            .write.option("lineSep", "\0\0")
            .option("compression", "none")
            .text(path)
        )
    return shards


def read_shards(spark, shards: Shards, *, with_ids: bool = True, start: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, ids_crc32[, ids]) of the records from slot ``start`` on,
    read from the files. Files before that slot are not opened; of its own file only
    the records from its byte on are cut out. A start beyond the last slot gives none.
    """
    stride = shards.stride
    if not shards.count:
        schema = "slot bigint, shard int, byte_offset bigint, ids_crc32 bigint"
        return spark.createDataFrame([], schema + ", ids binary" * with_ids)
    name = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1)
    # A file is a whole number of records; they are cut out of it one by one.
    first, skipped = F.lit(0).cast("bigint"), F.lit(True)
    if start:
        # The name is known from the listing, so the scan leaves other files out.
        number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
        skipped = number >= start // shards.records
        begin = start % shards.records * stride
        first = F.when(number == start // shards.records, F.lit(begin)).otherwise(0).cast("bigint")
        skipped &= F.col("length") > first
    at = F.explode(F.sequence(first, F.col("length") - stride, F.lit(stride).cast("bigint")))
    records = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(shards.path)
        .where((F.col("length") > 0) & skipped)
        .select(name.cast("int").alias("shard"), "content", at.alias("byte_offset"))
        .withColumn("ids", F.substring("content", (F.col("byte_offset") + 1).cast("int"), F.lit(stride)))
    )
    return records.select(
        (F.col("shard").cast("bigint") * shards.records + F.floor(F.col("byte_offset") / stride)).alias("slot"),
        "shard",
        "byte_offset",
        F.crc32("ids").alias("ids_crc32"),
        *["ids"] * with_ids,
    )


def materialise(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """(slot, shard, byte_offset, sequence, ids_crc32, doc_ids): write the shards
    into the shared folder, read them back, and name the documents of each record."""
    spark = docs.sparkSession
    shards = write_shards(docs, tokenizer, scratch_path(spark, "shards"), **options)
    # A sequence has at most `size` spans.
    held = shards.spans.groupBy("slot", "sequence").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("offset", "doc_id"))), lambda s: s["doc_id"]
        ).alias("doc_ids")
    )
    stored = read_shards(spark, shards, with_ids=False)
    return stored.join(held, "slot").select(
        "slot", "shard", "byte_offset", "sequence", "ids_crc32", "doc_ids"
    )
