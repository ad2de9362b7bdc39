"""WARC archives and the merge of their capture indexes.

Writing: payloads are grouped by digest; of equal ones that with the largest
id becomes a response record, the others revisit records that refer to it. The
records are written as they are, one after the other, into gzip archives of a
bounded number of records; offsets count uncompressed bytes.

Reading: each archive is parsed record by record, which gives one index row
per capture, sorted by URL key and time: a run. The runs meet in ranges of
(URL key, time, id), where a loser tree merges them. The ranges follow each
other, so the whole is one global order. A URL with very many captures is cut
by time like any other range.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import spread_join
from incidentia.session import scratch_path, written

RECORDS = 2_000
RUN_BATCH = 20_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NO_PAGE = -(2**63)
NO_TIME = "0001-01-01T00:00:00Z"
INDEX = (
    "url_key string, captured string, page_id bigint, archive string, byte_offset bigint, "
    "record_bytes bigint, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint"
)
_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_SCHEMA = pa.schema(
    [
        (n, pa.string() if f.endswith("string") else pa.int64())
        for n, f in zip(_NAMES, INDEX.split(", "))
    ]
)


# ---- Writing --------------------------------------------------------------------


def base32_of_hex(digest: Column) -> Column:
    """Base32 of 40 hex digits: five of them give four letters."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def _record_id(page_id: Column) -> Column:
    text = F.md5(page_id.cast("string"))
    parts = [F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*lines: Column) -> Column:
    return F.concat(*[F.concat(x, F.lit("\r\n")) for x in lines])


def decided(
    pages: DataFrame, page_id: str, url: str, html: str, captured: Column, least_bytes: int = 0
) -> DataFrame:
    """Pages with digest, record type and the id of the response they refer to."""
    rows = pages.select(
        F.coalesce(F.col(page_id).cast("bigint"), F.lit(NO_PAGE)).alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
        F.coalesce(F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(NO_TIME)).alias("captured"),
    )
    rows = rows.select(
        "*",
        F.sha1(F.col("payload").cast("binary")).alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.xxhash64("payload").alias("mark"),
    )
    key = ["sha1", "payload_bytes", "mark"]
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy(*key)
    chosen = written(groups.agg(F.max("page_id").alias("winner"), F.count("*").alias("n")), "payloads")
    found = spread_join(rows, chosen, key, F.xxhash64("page_id", "url"), how="left")
    revisit = F.col("winner") > F.col("page_id")
    return found.select(
        "page_id",
        "url",
        "captured",
        "payload",
        "payload_bytes",
        base32_of_hex(F.col("sha1")).alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("winner")).alias("refers_to"),
    )


def _record(target: Column) -> Column:
    """One WARC record without the two line ends after it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        _lines(
            F.lit("HTTP/1.1 200 OK"),
            F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")),
        ),
        F.lit("\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = _lines(
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
    )
    refers = _lines(
        F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to"))),
        F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("refers_to").cast("string")),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
    )
    rest = _lines(
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(
        header, F.coalesce(F.when(revisit, refers), F.lit("")), rest, F.lit("\r\n"), block
    )


def write_archives(
    pages: DataFrame,
    path: str,
    captured: Column,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    *,
    least_bytes: int = 0,
    records: int = RECORDS,
) -> None:
    """Write a record for each row of ``pages`` below ``path``.

    Null payloads are empty ones. A missing id is written as the smallest
    number there is, so it never wins; a missing time as ``NO_TIME``, the first
    of all. Rows that repeat the id and payload of a
    response are responses, too. Blanks and control characters of a URL are
    percent-encoded, a missing one is empty. Payloads below ``least_bytes`` are
    always written in full.
    """
    rows = decided(pages, page_id, url, html, captured, least_bytes)
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    writer = rows.select(_record(target).alias("record")).write
    # Each record ends with these two line ends, so the text writer sets them.
    writer.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records).option(
        "compression", "gzip"
    ).text(path)


# ---- Reading --------------------------------------------------------------------


def url_key(url: str) -> str:
    """Host parts in reverse order, then path and query: captures of a site sort together."""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + path


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, bytes, header fields, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8", "replace").split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = head + 4
        end = begin + int(fields["content-length"])
        yield at, end + 4 - at, fields, data[begin:end]
        at = end + 4


def _capture(archive: str, at: int, size: int, fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{archive}: the payload at {at} has another digest")
    refers = fields.get("x-refers-to-page-id")
    return (
        url_key(fields.get("warc-target-uri", "")),
        fields["warc-date"],
        int(fields["x-page-id"]),
        archive,
        at,
        size,
        kind,
        len(payload) if kind == "response" else int(lengths[0].partition(b":")[2]),
        digest,
        None if refers is None else int(refers),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_SCHEMA)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def runs(spark, path: str) -> DataFrame:
    """Index rows of all archives below ``path``; those of an archive are sorted."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["archive"].to_pylist(), batch["content"]):
                data = gzip.decompress(content.as_buffer().to_pybytes())
                yield _batch(sorted((_capture(name, *r) for r in records(data)), key=order))

    return files.mapInArrow(run, INDEX)


def order(row: tuple) -> tuple:
    """Sort key of an index row: URL key, time, id, archive, offset."""
    return row[:5]


class LoserTree:
    """Merges sorted runs: each inner node holds the loser of its match, so the
    next row costs one match per level."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.size = max(1, len(sources))
        self.losers = [-1] * self.size
        self.winner = -1
        for i in range(len(sources)):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        """Run ``a`` comes before run ``b``; ended runs come last, ties go to the earlier run."""
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (order(self.heads[a]), a) < (order(self.heads[b]), b)

    def _play(self, run: int) -> None:
        at = (run + self.size) // 2
        while at:
            if self.losers[at] < 0:
                # The first to come waits for the winner of the other side.
                self.losers[at] = run
                return
            if self._before(self.losers[at], run):
                self.losers[at], run = run, self.losers[at]
            at //= 2
        self.winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.sources[run], None)
            self._play(run)


def merged(index: DataFrame) -> DataFrame:
    """The index in global order of URL key, time, id, archive and offset.

    Within a range the rows come as pieces of runs, in any order of pieces; a
    new run begins where a row sorts before the one ahead of it.
    """
    ranges = index.repartitionByRange("url_key", "captured", "page_id", "archive", "byte_offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not held or order(row) < order(held[-1][-1]):
                    held.append([])
                held[-1].append(row)
        out: list[tuple] = []
        for row in LoserTree([iter(r) for r in held]):
            out.append(row)
            if len(out) == RUN_BATCH:
                yield _batch(out)
                out = []
        yield _batch(out)

    return ranges.mapInArrow(run, INDEX)


def captures(pages: DataFrame, captured: Column, **options) -> DataFrame:
    """Write the archives into the shared folder, read them back, and merge
    their indexes into one; see ``write_archives`` for the columns. Missing ids
    are null again. No pages give no captures."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, captured, **options)
    index = written(merged(written(runs(spark, path), "capture-runs")), "capture-index")
    return index.withColumn("page_id", F.when(F.col("page_id") != NO_PAGE, F.col("page_id")))
