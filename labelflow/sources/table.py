"""A results table with commits: snapshots for readers, upserts, compaction.

Rows live in hash buckets of their key. Each version of the table is a manifest, a
small file that lists the folders of every bucket, put in place by an atomic
create-if-absent under the next number. Readers take the newest manifest and
never see a write in progress; of two writers one wins and the other tries again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.operators.positions import free_name
from labelflow.operators.results import content_hash
from labelflow.storage import materialise

#: Attempts of a commit that others keep overtaking.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Other writers committed first, again and again."""


@dataclass(frozen=True)
class Snapshot:
    """A version: folders by bucket, and the last batch of each stream."""

    version: int
    key: str
    buckets: int
    schema: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    operation: str = "create"
    rows: int = 0


class _Files:
    """The few file operations of a table, by the cluster's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of the last change in milliseconds) of what a folder holds."""
        if not self.fs.exists(self.path(folder)):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Create the file, whole, or return False if there is one.

        A finished file is moved to its name, which fails if the name is taken
        (HDFS and file systems like it). On a local disk, where a move would
        overwrite, it gets the name as a link.
        """
        temporary = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(temporary, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = self.path(name)
        try:
            if self.fs.getUri().getScheme() != "file":
                return bool(self.fs.rename(temporary, target))
            link, file = (self.jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, temporary))
            self.jvm.java.nio.file.Files.createLink(link, file)
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(temporary, False)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class ResultTable:
    """Rows with unique, or repeated, keys below a shared folder.

    ``buckets`` is fixed when the table is made: choose it so that one bucket's
    rows suit a task, as an upsert rewrites the buckets it touches and no other.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self.files = _Files(spark, self.root)

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, schema: str | T.StructType, key: str = "id", buckets: int = 64
    ) -> ResultTable:
        """A new, empty table; one that is there already is opened."""
        table = cls(spark, path)
        parsed = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        table._put(Snapshot(0, key, buckets, parsed.json()))
        return table

    def versions(self) -> list[int]:
        names = [n for n, _ in self.files.names("_log")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        number = self.versions()[-1] if version is None else version
        return Snapshot(**json.loads(self.files.read(f"_log/{number:020d}.json")))

    def _put(self, snapshot: Snapshot) -> bool:
        return self.files.put(f"_log/{snapshot.version:020d}.json", json.dumps(vars(snapshot)))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest, whatever is committed later."""
        snapshot = self.snapshot(version)
        return self._rows(snapshot, [f for fs in snapshot.folders.values() for f in fs])

    def _rows(self, snapshot: Snapshot, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(snapshot.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def history(self) -> DataFrame:
        """One row per version that is kept: version, operation and the rows it wrote."""
        found = [self.snapshot(v) for v in self.versions()]
        return self.spark.createDataFrame(
            [(s.version, s.operation, s.rows) for s in found], "version long, operation string, rows long"
        )

    def _bucket(self, snapshot: Snapshot) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{snapshot.key}`")), F.lit(snapshot.buckets)).cast("int")

    def _write(self, snapshot: Snapshot, rows: DataFrame) -> tuple[dict[str, list[str]], int]:
        """Rows in a new folder for each bucket, and how many, counted by the write."""
        names = T.StructType.fromJson(json.loads(snapshot.schema)).fieldNames()
        name = free_name(rows, "bucket")
        folder, seen = f"data/{uuid.uuid4().hex}", Observation()
        (
            rows.select(*[f"`{n}`" for n in names], self._bucket(snapshot).alias(name))
            .repartition(name)
            .observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.partitionBy(name)
            .option("compression", "zstd")
            .parquet(f"{self.root}/{folder}")
        )
        found = [n for n, _ in self.files.names(folder) if n.startswith(f"{name}=")]
        return {n.partition("=")[2]: [f"{folder}/{n}"] for n in found}, seen.get["rows"]

    def _commit(
        self,
        operation: str,
        batch: tuple[str, int] | None,
        make: Callable[[Snapshot], tuple[dict[str, list[str]], int]],
        replaces: bool,
    ) -> int:
        """Put the folders that ``make`` writes into the next version.

        If others were first, the folders stay good as long as none of their
        buckets changed (or if they only add rows); otherwise they are made anew
        from the newest version. A batch that a version has already is left out.
        """
        read = made = None
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            if batch and now.batches.get(batch[0], -1) >= batch[1]:
                return now.version
            if made is None or (
                replaces and any(now.folders.get(b) != read.folders.get(b) for b in made[0])
            ):
                read, made = now, make(now)
            folders = dict(now.folders)
            for bucket, new in made[0].items():
                folders[bucket] = new if replaces else folders.get(bucket, []) + new
            done = replace(
                now, version=now.version + 1, folders=folders, operation=operation, rows=made[1],
                batches=now.batches | ({batch[0]: batch[1]} if batch else {}),
            )
            if self._put(done):
                return done.version
        raise Conflict(f"{operation} of {self.root}: {ATTEMPTS} attempts")

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Add rows without a look at their keys. ``batch`` is a stream's name and
        the number of its batch: a replay of it changes nothing. Returns the version."""
        return self._commit("append", batch, lambda now: self._write(now, rows), replaces=False)

    def upsert(
        self, rows: DataFrame, order: Column | None = None, batch: tuple[str, int] | None = None
    ) -> int:
        """Put rows in place of those with their keys, or add them.

        Of several rows with one key the one with the largest ``order`` counts,
        ties by a hash of the content. Only the buckets of the new rows are
        rewritten; their old rows are read without those that go.
        """
        key = self.snapshot().key
        rest = [c for c in rows.columns if c != key]
        best = F.struct(*([order.alias("o")] if order is not None else []), content_hash(rows, rest).alias("h"))
        one = materialise(
            rows.groupBy(key).agg(F.max_by(F.struct(*rest), best).alias("x")).select(key, "x.*")
            if rest else rows.distinct()
        )

        def make(now: Snapshot):
            touched = {
                str(r[0]) for r in one.select(self._bucket(now)).distinct().collect()
            }  # at most one row for each bucket
            held = [f for b, fs in now.folders.items() if b in touched for f in fs]
            kept = self._rows(now, held)
            if held:
                kept = kept.join(one.select(key), kept[key].eqNullSafe(one[key]), "left_anti")
            return self._write(now, kept.unionByName(one.select(*kept.columns)))

        return self._commit("upsert", batch, make, replaces=True)

    def compact(self, at_least: int = 2) -> int:
        """Merge the folders of buckets that have so many. Rows stay as they are."""

        def make(now: Snapshot):
            many = [f for fs in now.folders.values() if len(fs) >= at_least for f in fs]
            return self._write(now, self._rows(now, many)) if many else ({}, 0)

        return self._commit("compact", None, make, replaces=True)

    def vacuum(self, keep: int = 1, orphan_seconds: float = 86_400) -> None:
        """Remove all but the newest ``keep`` versions, the folders that only they
        have, and folders of writes that no version ever got and that are older
        than ``orphan_seconds``. Readers of removed versions lose their files."""
        versions = self.versions()
        old, new = versions[:-keep], versions[-keep:]
        kept = {f for v in new for fs in self.snapshot(v).folders.values() for f in fs}
        dropped = {f for v in old for fs in self.snapshot(v).folders.values() for f in fs} - kept
        for version in old:
            self.files.delete(f"_log/{version:020d}.json")
        for folder in dropped:
            self.files.delete(folder)
        writes = {f.rpartition("/")[0] for f in kept}
        now = self.files.jvm.java.lang.System.currentTimeMillis()
        for name, changed in self.files.names("data"):
            left = f"data/{name}"
            if left not in writes and (
                now - changed > 1000 * orphan_seconds or not self.files.names(left)
                or any(f.startswith(f"{left}/") for f in dropped)
            ):
                self.files.delete(left)
