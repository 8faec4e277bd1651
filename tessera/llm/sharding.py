"""Operator 7: size-tiered compaction of immutable shards under versioned manifests, in DataFrame functions only.

``append`` writes an arrival as small shards (files) and commits a manifest that lists them beside the old ones.
``compact`` merges the shards of every tier that holds at least ``fan_in`` of them into files of the target size:
the scan packs whole files into tasks of that size and each task writes one file, so nothing is shuffled. Shards
of the target size or more are final. A manifest is a table written aside and renamed to the next version number;
the rename fails if that version exists, so of two writers one starts over, and readers see whole versions only. A
writer names its folder in ``intents/`` before it writes, so that ``expire`` leaves uncommitted shards alone.

A manifest has a row for each file, and reading a version lists those files on the driver, as Spark's own scan does.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from tessera.llm.common import Scratch, crc_mod, documents

TARGET = 128 << 20
LEAST = 1 << 20
FAN_IN = 4
MANIFEST = "path string, tier int, n_rows long, n_bytes long, low long, high long, added long"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class LostShards(RuntimeError):
    """Files that should be there are not: a writer's own, or such as the newest manifest lists. No retry brings them back."""


class ShardStore:
    """A table of documents under ``root``: ``data/`` holds shards, ``manifests/`` a table for each version.

    Rows are kept as they come: nulls, empty texts, repeated rows and further columns alike; all arrivals of a
    store must have the columns of the first. An empty arrival commits a version without new shards.
    """

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, least: int = LEAST, fan_in: int = FAN_IN) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.least, self.fan_in = target, least, fan_in

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at = self._path("manifests")
        if not self._fs().exists(at):
            return []
        return sorted(int(x.getPath().getName()[1:]) for x in self._fs().listStatus(at) if x.getPath().getName().startswith("v"))

    def manifest(self, version: int | None = None) -> DataFrame:
        found = self.versions()
        if version is None and not found:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/v{(version or found[-1]):010d}")

    def _folder(self) -> str:
        """A new data folder, announced before anything is written to it."""
        folder = uuid.uuid4().hex
        self._fs().mkdirs(self._path("intents", folder))
        return folder

    def _commit(self, rows: DataFrame, version: int, folders: list[str]) -> int:
        aside = f"_staging/{uuid.uuid4().hex}"
        rows.select("path", "tier", "n_rows", "n_bytes", "low", "high", "added").coalesce(1).write.parquet(f"{self.root}/{aside}")
        fs, jvm = self._fs(), self.spark._jvm
        fs.mkdirs(self._path("manifests"))
        to = self._path("manifests", f"v{version:010d}")
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._path(aside), to, options)
        except Py4JJavaError as error:
            fs.delete(self._path(aside), True)
            if "FileAlreadyExists" in str(error.java_exception):
                raise Conflict(f"version {version} exists") from error
            raise
        for folder in folders:
            fs.delete(self._path("intents", folder), True)
        return version

    def _shards(self, folder: str, version: int, id_column: str) -> DataFrame:
        """A manifest row for each file of a folder, from the files' own metadata."""
        try:
            files = self.spark.read.parquet(f"{self.root}/data/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return self.spark.createDataFrame([], MANIFEST)
        per = files.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes"), F.min(id_column).alias("low"), F.max(id_column).alias("high")
        )
        ratio = F.greatest(F.col("n_bytes") / self.least, F.lit(1.0))
        tier = F.when(F.col("n_bytes") >= self.target, 99).otherwise(F.floor(F.log(float(self.fan_in), ratio))).cast("int")
        return per.withColumn("tier", tier).withColumn("added", F.lit(version).cast("long"))

    def append(self, rows: DataFrame, id_column: str = "doc_id") -> int:
        """Adds an arrival; one shard for each of its partitions. After a conflict the same shards join the newer version."""
        folder = self._folder()
        rows.write.option("compression", "zstd").parquet(f"{self.root}/data/{folder}")
        while True:
            last = self.versions()
            version = (last[-1] if last else 0) + 1
            old = self.manifest(last[-1] if last else None)
            try:
                return self._commit(old.unionByName(self._shards(folder, version, id_column)), version, [folder])
            except (Conflict, Py4JJavaError, PySparkException) as error:
                self._start_over(error, last[-1] if last else None, [folder])

    def _start_over(self, error: Exception, version: int | None, folders: list[str]) -> None:
        """Returns if another writer was faster: it took the version, or the manifest that was read is gone. Else raises."""
        lost = [x for x in folders if not self._fs().exists(self._path("data", x))]
        if lost:
            raise LostShards(f"the writer's folders {lost} are gone; were its intents forgotten?") from error
        if not isinstance(error, Conflict) and (version is None or version in self.versions()):
            raise error

    def compact(self, id_column: str = "doc_id") -> int | None:
        """One round over all tiers that are due; the new version, or None where none is.

        After a conflict the merged shards join the newer version if it still lists what they were merged from;
        else another compaction came first, the round's work is dropped and the next round looks anew.
        """
        last = self.versions()
        if not last:
            return None
        size = Window.partitionBy("tier")
        marked = self.manifest(last[-1]).withColumn("due", (F.col("tier") < 99) & (F.count(F.lit(1)).over(size) >= self.fan_in))
        due = [(r.tier, r.paths) for r in marked.where("due").groupBy("tier").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("tier").collect()]
        if not due:
            return None
        packing = {"spark.sql.files.maxPartitionBytes": str(self.target), "spark.sql.files.openCostInBytes": "65536", "spark.sql.files.minPartitionNum": "1"}
        before = {k: self.spark.conf.get(k, None) for k in packing}
        folders, merged = [], self.spark.createDataFrame([(x,) for _, paths in due for x in paths], "path string")
        for _, paths in due:
            folders.append(self._folder())
            try:
                for k, v in packing.items():
                    self.spark.conf.set(k, v)
                self.spark.read.parquet(*paths).write.option("compression", "zstd").parquet(f"{self.root}/data/{folders[-1]}")
            except (Py4JJavaError, PySparkException) as error:
                self._give_up(folders)
                if merged.join(self.manifest(), "path", "left_anti").isEmpty():
                    raise LostShards("shards that the newest manifest lists cannot be read") from error
                return self.versions()[-1]  # another compaction came first and dropped what was read
            finally:
                for k, v in before.items():
                    self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        while True:
            version = self.versions()[-1] + 1
            now = self.manifest(version - 1)
            if version - 1 != last[-1] and not merged.join(now, "path", "left_anti").isEmpty():
                self._give_up(folders)
                return version - 1
            out = now.join(merged, "path", "left_anti")
            for folder in folders:
                out = out.unionByName(self._shards(folder, version, id_column))
            try:
                return self._commit(out, version, folders)
            except (Conflict, Py4JJavaError, PySparkException) as error:
                self._start_over(error, version - 1, folders)

    def _give_up(self, folders: list[str]) -> None:
        for folder in folders:
            self._fs().delete(self._path("data", folder), True)
            self._fs().delete(self._path("intents", folder), True)

    def settle(self, id_column: str = "doc_id", keep: int = 1) -> int:
        """Compacts until no tier is due or a round merges nothing further; then drops what only old versions need."""
        while True:
            count = self.manifest().count()
            if self.compact(id_column) is None:
                break
            self.expire(keep)
            if self.manifest().count() >= count:  # the same runs again: each is a task's worth already
                break
        return self.versions()[-1]

    def expire(self, keep: int = 1) -> None:
        """Drops all versions but the last ``keep``, and the folders that those don't list and no writer has announced.

        Readers of an older version need it kept. A writer that died leaves its intent; ``forget`` removes it.
        """
        fs = self._fs()
        announced = set(self._names("intents"))  # before the versions: what is committed in between is listed there
        folders, found = self._names("data"), self.versions()
        live: set[str] = set()
        for version in found[-keep:]:
            live |= {r.folder for r in self.manifest(version).select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct().collect()}
        for version in found[:-keep]:
            fs.delete(self._path("manifests", f"v{version:010d}"), True)
        for folder in folders:
            if folder not in live and folder not in announced:
                fs.delete(self._path("data", folder), True)

    def forget(self, older_than_ms: int) -> None:
        """Removes intents that were announced longer ago than that: their writers are taken for dead."""
        fs, at = self._fs(), self._path("intents")
        now = self.spark._jvm.System.currentTimeMillis()
        for status in fs.listStatus(at) if fs.exists(at) else []:
            if now - status.getModificationTime() > older_than_ms:
                fs.delete(status.getPath(), True)

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [x.getPath().getName() for x in self._fs().listStatus(at)] if self._fs().exists(at) else []

    def read(self, version: int | None = None) -> DataFrame:
        paths = [r.path for r in self.manifest(version).select("path").collect()]
        return self.spark.read.parquet(*paths)


def op7_tiered_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five arrivals of falling size, compacted as they come; every document read back through the last manifest."""
    docs, store = documents(spark, sf_dir), ShardStore(spark, Scratch(spark, "shards").path("store"))
    part = crc_mod("doc_id", 16)
    for low, high in ((0, 8), (8, 12), (12, 14), (14, 15), (15, 16)):
        store.append(docs.where((part >= low) & (part < high)))
    store.settle()
    return store.read().select("doc_id", "source", "lang", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))
