"""Stored tables with versions: immutable files, and manifests that name them.

A table is a folder. `data/` holds folders of files that are written once and never
changed, `versions/` one small JSON file per version: the rows as of the last
compaction (`base`), the key states that batches have added since (`states`), rows
without a key and log rows (`loose`), and the last batch taken from each stream. A
version comes into being by the rename of its finished manifest, which fails if there
is one of that number already. So a reader sees a whole table or the one before it, a
reader opened earlier keeps its files, a writer that dies leaves files nobody names,
and a batch that a stream replays is found in the manifest and left out.

Files are reached through the file system of the path, whatever store it is in.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import merge
from gleanery.sources.postings import union_all
from gleanery.sources.tables import evolve

#: Manifests are read whole by the driver; compaction keeps them short.
MANIFEST_BYTES = 16 << 20


class Conflict(RuntimeError):
    """Another writer has made this version."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    base: str | None = None
    states: list[str] = field(default_factory=list)
    loose: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def folders(self) -> set[str]:
        return {*([self.base] if self.base else []), *self.states, *self.loose}


class Table:
    """One versioned table below `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests -------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("versions").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the finished versions."""
        fs, path = self._files(), self._path("versions")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A version, by default the newest one."""
        if number is None:
            known = self.versions()
            if not known:
                raise FileNotFoundError(f"no table at {self.root}")
            number = known[-1]
        fs, path = self._files(), self._path(f"versions/{number:012d}.json")
        if fs.getFileStatus(path).getLen() > MANIFEST_BYTES:
            raise ValueError(f"manifest {number} of {self.root} is too long; compact the table")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def commit(self, version: Version) -> Version:
        """Make it the newest version; `Conflict` if its number is taken."""
        jvm, fs = self.spark._jvm, self._files()
        temp = self._path(f"versions/.{version.number:012d}-{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        try:
            out.write(json.dumps(asdict(version)).encode())
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            temp.toUri(), self.spark._jsc.hadoopConfiguration())
        keep = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(context.makeQualified(temp), context.makeQualified(
                self._path(f"versions/{version.number:012d}.json")), keep)
        except Exception as failure:
            fs.delete(temp, False)
            if version.number in self.versions():
                raise Conflict(f"version {version.number} of {self.root}") from failure
            raise
        return version

    # --- reading ---------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        """The rows as of a version. The files are fixed here, at the call, not when rows are read."""
        version = self.version(number)
        fields = version.columns
        stored = self._folder(version.base, fields) if version.base else self.spark.createDataFrame([], fields)
        loose = [self._folder(x, fields) for x in version.loose]
        if not version.states:
            return union_all([stored, *loose])
        keyed, unkeyed = merge.split_keyed(stored)
        states = merge.fold_states(union_all([self.spark.read.parquet(f"{self.root}/data/{x}") for x in version.states]))
        merged = merge.merge_collapsed(keyed, merge.expand_states(states).select(
            *[c for c in fields.names if c != "is_active"]))
        return union_all([merged, unkeyed, *loose]).select(*fields.names)

    def _folder(self, name: str, fields: T.StructType) -> DataFrame:
        return self.spark.read.schema(fields).parquet(f"{self.root}/data/{name}")

    # --- writing ---------------------------------------------------------

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.mode("errorifexists").parquet(f"{self.root}/data/{name}")
        return name

    def switch(self, rows: DataFrame, batches: dict[str, int] | None = None, partition: str | None = None,
               order: str | None = None, max_records: int = 5_000_000) -> Version:
        """Replace the whole table, or make it; rows may read the table itself.

        With a partition column files are rebalanced by its size and sorted by `order`.
        """
        known = self.versions()
        last = self.version(known[-1]) if known else None
        shaped = rows
        if partition:
            shaped = rows.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *([order] if order else []))
        name = uuid.uuid4().hex
        writer = shaped.write.mode("errorifexists").option("maxRecordsPerFile", max_records)
        (writer.partitionBy(partition) if partition else writer).parquet(f"{self.root}/data/{name}")
        return self.commit(Version(
            last.number + 1 if last else 0, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]).json(),
            base=name, batches=batches if batches is not None else last.batches if last else {}))

    def append(self, rows: DataFrame) -> Version:
        """Rows added as they are; the table is made by the first of them."""
        known = self.versions()
        if not known:
            return self.switch(rows)
        last = self.version(known[-1])
        name = self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in last.columns]))
        return self.commit(replace(last, number=last.number + 1, loose=[*last.loose, name]))

    def upsert(self, batch: DataFrame, order: list[str], stream: str, batch_id: int) -> Version:
        """Merge one batch of a stream on (source, external_id), as `merge.merge_upsert` would.

        Costs the size of the batch: one state per key is written and folded on read. A
        batch that the table has taken already changes nothing.
        """
        last = self.version()
        if last.batches.get(stream, -1) >= batch_id:
            return last
        columns = last.columns
        batch = evolve(batch, columns).withColumn("_version", F.lit(last.number))
        keyed, loose = merge.split_keyed(batch)
        by_policy = merge.policy([c for c in columns.names if c != "is_active"])
        states = merge.key_states(keyed, ["_version", *order], *by_policy)
        rows = loose.withColumn("is_active", F.lit(True)).select(
            *[F.col(f.name).cast(f.dataType) for f in columns])
        batch.persist()
        try:
            added = replace(last, number=last.number + 1, states=[*last.states, self._write(states)],
                            loose=[*last.loose, self._write(rows)], batches={**last.batches, stream: batch_id})
        finally:
            batch.unpersist()
        return self.commit(added)

    def compact(self, partition: str | None = None, order: str | None = None) -> Version:
        """The same rows, folded into one base."""
        return self.switch(self.read(), partition=partition, order=order)

    def vacuum(self, keep: int = 2, min_age: float = 86_400.0) -> list[str]:
        """Delete all but the last `keep` versions, and files that none of those name.

        Files younger than `min_age` seconds stay: a writer may be about to name them.
        """
        fs, numbers = self._files(), self.versions()
        named = set().union(*[self.version(n).folders() for n in numbers[-keep:]]) if numbers else set()
        for n in numbers[:-keep]:
            fs.delete(self._path(f"versions/{n:012d}.json"), False)
        gone, data = [], self._path("data")
        for status in fs.listStatus(data) if fs.exists(data) else []:
            name = status.getPath().getName()
            if name not in named and status.getModificationTime() / 1000 <= time.time() - min_age:
                fs.delete(status.getPath(), True)
                gone.append(name)
        return gone


def retried(step, attempts: int = 5):
    """The result of step(), taken again if another writer was faster."""
    for left in reversed(range(attempts)):
        try:
            return step()
        except Conflict:
            if not left:
                raise
    raise AssertionError
