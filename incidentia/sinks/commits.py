"""Tables kept by commits: appended by batch, packed and replaced in one step.

A table is a folder of parts, ``<path>/commit_part=<name>``, each written by one Spark
job. A commit is a small file ``<path>/_commits/<number>`` that lists the parts
which make up the table from then on. It comes into being by a rename, so a
reader sees the table before the commit or after it, never in between. Parts
that a commit no longer lists stay for readers that began earlier, until
``remove_old`` deletes them.

A batch is committed once: its numbers go with its part (and with the part that
a pack makes of several), so a batch that is run again adds nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incidentia.sinks.folders import folder

COMMITS = "_commits"
PART = "commit_part"
# Parts below this size are packed, and so many commits stay readable.
PACK_BYTES = 128 * 1024 * 1024
KEPT_COMMITS = 20
ATTEMPTS = 50


@dataclass(frozen=True)
class Part:
    """A folder of the table, the batches in it, its size, and numbers of its writer."""

    name: str
    batches: tuple[tuple[str, int, int], ...] = ()  # (stream, first, last)
    files: int = 0
    size: int = 0
    rows: int = 0

    def holds(self, stream: str, batch: int) -> bool:
        return any(s == stream and a <= batch <= b for s, a, b in self.batches)


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    # ---- Commits ----

    def numbers(self) -> list[int]:
        place, system = folder(self.spark, f"{self.path}/{COMMITS}")
        if not system.exists(place):
            return []
        names = [s.getPath().getName() for s in system.listStatus(place)]
        return sorted(int(n) for n in names if n.isdigit())

    def parts(self, number: int | None = None) -> list[Part]:
        """The parts of a commit, the newest one if none is named."""
        if number is None:
            known = self.numbers()
            if not known:
                return []
            number = known[-1]
        place, system = folder(self.spark, f"{self.path}/{COMMITS}/{number}")
        source = system.open(place)
        text = self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)
        source.close()
        found = [json.loads(line) for line in bytes(text).decode("utf-8").splitlines()]
        return [Part(**{**p, "batches": tuple(tuple(b) for b in p["batches"])}) for p in found]

    def _commit(self, change: Callable[[list[Part]], list[Part] | None]) -> bool:
        """Make the next commit from the newest one; anew if another writer was
        faster. ``change`` gives None if there is nothing to do."""
        for _ in range(ATTEMPTS):
            known = self.numbers()
            parts = change(self.parts(known[-1]) if known else [])
            if parts is None:
                return False
            if self._write_commit(known[-1] + 1 if known else 0, parts):
                return True
        raise RuntimeError(f"{self.path}: other writers committed first {ATTEMPTS} times")

    def _write_commit(self, number: int, parts: list[Part]) -> bool:
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        text = "".join(json.dumps(asdict(p)) + "\n" for p in parts).encode("utf-8")
        log = f"{self.path}/{COMMITS}"
        draft, system = folder(self.spark, f"{log}/.draft-{uuid.uuid4().hex}")
        target, _ = folder(self.spark, f"{log}/{number}")
        out = system.create(draft)
        out.write(text)
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        keep = gateway.new_array(rename, 1)
        keep[0] = rename.NONE
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(target), keep)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            system.delete(draft, False)
            return False

    # ---- Parts ----

    def _folder_of(self, name: str) -> str:
        return f"{self.path}/{PART}={name}"

    def _written(self, rows: DataFrame, name: str, partition_by: tuple[str, ...]) -> Part:
        """Write a part; its rows are counted by the same job."""
        counted = Observation()
        observed = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = observed.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self._folder_of(name))
        place, system = folder(self.spark, self._folder_of(name))
        held = system.getContentSummary(place)
        return Part(name, (), held.getFileCount(), held.getLength(), counted.get["rows"])

    def append(
        self, rows: DataFrame, batch: int, *, stream: str = "", partition_by: tuple[str, ...] = ()
    ) -> int:
        """Add the rows of a batch; says how many it has. A batch that the table
        holds already adds nothing, and its rows are not computed (once it is
        packed with others, their number is not known any more and given as 0)."""
        for part in self.parts():
            if part.holds(stream, batch):
                return part.rows if part.batches == ((stream, batch, batch),) else 0
        name = f"{stream or 'batch'}-{batch}-{uuid.uuid4().hex[:8]}"
        made = replace(self._written(rows, name, partition_by), batches=((stream, batch, batch),))

        if not made.rows:
            place, system = folder(self.spark, self._folder_of(name))
            system.delete(place, True)
            return 0

        def add(parts: list[Part]) -> list[Part] | None:
            return None if any(p.holds(stream, batch) for p in parts) else [*parts, made]

        self._commit(add)
        return made.rows

    def overwrite(self, rows: DataFrame, *, partition_by: tuple[str, ...] = ()) -> None:
        """Put ``rows`` in the place of the whole table. Until they are all
        written, and if that fails, readers find the table as it was."""
        made = self._written(rows, f"whole-{uuid.uuid4().hex[:8]}", partition_by)
        self._commit(lambda parts: [made])

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the newest commit, or of an earlier one."""
        parts = self.parts(number)
        # An empty table may still have a file that tells its columns.
        held = [p for p in parts if p.rows] or [p for p in parts if p.files][:1]
        live = [self._folder_of(p.name) for p in held]
        if not live or self.schema is not None and not held[0].rows:
            if self.schema is None:
                raise FileNotFoundError(f"{self.path} holds no rows.")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.option("basePath", self.path).parquet(*live).drop(PART)

    # ---- Upkeep ----

    def pack(
        self,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        *,
        at_least: int = 8,
        small: int = PACK_BYTES,
        partition_by: tuple[str, ...] = (),
    ) -> int:
        """Make one part of all parts with files below ``small`` bytes on
        average, if there are ``at_least`` so many; says how many it took.

        ``merge`` may combine their rows, as far as the table's meaning allows.
        What is committed meanwhile stays beside the new part.
        """
        old = [p for p in self.parts() if p.size < small * max(1, p.files)]
        if len(old) < at_least:
            return 0
        names = {p.name for p in old}
        folders = [self._folder_of(p.name) for p in old if p.rows]
        batches = _joined(b for p in old for b in p.batches)
        if folders:
            reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
            rows = reader.option("basePath", self.path).parquet(*folders).drop(PART)
            rows = rows if merge is None else merge(rows)
            # Adaptive execution gives the files their size: a large month is split, small ones share a task.
            gathered = rows.hint("rebalance", *map(F.col, partition_by)) if partition_by else rows.hint("rebalance")
            made = replace(
                self._written(gathered, f"pack-{uuid.uuid4().hex[:8]}", partition_by), batches=batches
            )
        else:
            made = Part(f"none-{uuid.uuid4().hex[:8]}", batches)

        def swap(parts: list[Part]) -> list[Part] | None:
            if not names <= {p.name for p in parts}:
                return None  # replaced meanwhile
            return [made, *(p for p in parts if p.name not in names)]

        return len(old) if self._commit(swap) else 0

    def remove_old(self, keep: int = KEPT_COMMITS) -> None:
        """Delete all but the ``keep`` newest commits, and parts that none of
        these lists. Only where no other writer is at work: its part is not
        listed yet."""
        known = self.numbers()
        kept = known[-keep:]
        live = {p.name for n in kept for p in self.parts(n)}
        place, system = folder(self.spark, self.path)
        for status in system.listStatus(place):
            name = status.getPath().getName()
            if name.startswith(f"{PART}=") and name.removeprefix(f"{PART}=") not in live:
                system.delete(status.getPath(), True)
        for number in known[: -len(kept)]:
            system.delete(folder(self.spark, f"{self.path}/{COMMITS}/{number}")[0], False)


def _joined(batches) -> tuple[tuple[str, int, int], ...]:
    """Runs of batch numbers, put together where they touch."""
    out: list[list] = []
    for stream, first, last in sorted(batches):
        if out and out[-1][0] == stream and first <= out[-1][2] + 1:
            out[-1][2] = max(out[-1][2], last)
        else:
            out.append([stream, first, last])
    return tuple(tuple(b) for b in out)
