"""A long run that can be stopped anywhere: work is dealt into parts, and each part's result counts once it is committed.

What is to be done lies in generations of parts; a commit is one small file that appears by rename and names the
folder of a part's result. A run works off the parts without a commit. Killed between a result and its commit, it
leaves a folder that nobody reads and repeats that one part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Work = Callable[[DataFrame], DataFrame]


class ResumableRun:
    """``gather`` adds rows to be done, ``resume`` does them, ``results``, ``fails`` and ``status`` tell what came of it.

    ``folder`` must be one that driver and executors share. One driver at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, parts: int = 16) -> None:
        self.spark, self.folder, self.key, self.parts = spark, folder.rstrip("/"), key, parts
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # commits: {"kind": "gathered" | "done", "generation", "part", "path", "rows", "fails"}

    def _commit(self, name: str, **said: object) -> None:
        at, to = (self._hadoop.Path(f"{self.folder}/{x}") for x in (f"_{uuid.uuid4().hex}", f"commits/{name}.json"))
        self._fs.mkdirs(to.getParent())
        out = self._fs.create(at)
        out.write(json.dumps(said).encode())
        out.close()
        if self._fs.exists(to) or not self._fs.rename(at, to):
            raise RuntimeError(f"{name} was committed by another run")

    def commits(self) -> list[dict]:
        """All commits: one for a generation and one for a finished part, so as many as parts at most."""
        if not self._fs.exists(self._hadoop.Path(f"{self.folder}/commits")):
            return []
        rows = self.spark.read.text(f"{self.folder}/commits", wholetext=True).collect()
        return sorted((json.loads(r.value) for r in rows), key=lambda c: (c["generation"], c["part"]))

    def _read(self, kind: str) -> DataFrame | None:
        paths = [c["path"] for c in self.commits() if c["kind"] == kind and c["path"]]
        return self.spark.read.parquet(*paths) if paths else None

    def gathered(self) -> DataFrame | None:
        """All rows to be done so far, done or not."""
        held = [c["path"] for c in self.commits() if c["kind"] == "gathered" and c["path"]]
        if not held:
            return None
        out = self.spark.read.parquet(held[0])
        for path in held[1:]:
            out = out.unionByName(self.spark.read.parquet(path), allowMissingColumns=True)
        return out.drop("__part")

    def gather(self, rows: DataFrame) -> int:
        """Adds the rows whose key was never gathered as a new generation, a row a key; returns how many.

        Keys that are null are left out.
        """
        before = self.gathered()
        fresh = rows.where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        if before is not None:
            fresh = fresh.join(before.select(self.key), self.key, "left_anti")
        generation = sum(c["kind"] == "gathered" for c in self.commits())
        path = f"{self.folder}/todo/{generation}-{uuid.uuid4().hex}"
        part = F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")
        # a part's rows come together, in as many tasks and files as their bytes ask for
        fresh.withColumn("__part", part).hint("rebalance", "__part").write.partitionBy("__part").parquet(path)
        n = self.spark.read.schema(fresh.schema).parquet(path).count()
        self._commit(f"gathered-{generation}", kind="gathered", generation=generation, part=-1, path=path if n else "", rows=n, fails=0)
        return n

    def resume(self, work: Work, most: int | None = None) -> list[tuple[int, int]]:
        """Works off the parts that have no commit, ``most`` of them at most; returns those done.

        ``work`` maps a part's rows to results; rows of it whose ``error`` is not null, if it has such a column, are fails
        and do not stop the run.
        """
        said = self.commits()
        over = {(c["generation"], c["part"]) for c in said if c["kind"] == "done"}
        ran: list[tuple[int, int]] = []
        for source in [c for c in said if c["kind"] == "gathered" and c["path"]]:
            rows = self.spark.read.parquet(source["path"])
            there = sorted(r["__part"] for r in rows.select("__part").distinct().collect())
            for part in there:
                if (source["generation"], part) in over:
                    continue
                if most is not None and len(ran) >= most:
                    return ran
                name = f"{source['generation']}-{part}"
                path = f"{self.folder}/done/{name}-{uuid.uuid4().hex}"
                work(rows.where(F.col("__part") == part).drop("__part")).write.parquet(path)
                got = self.spark.read.parquet(path)
                bad = got.where("error is not null").count() if "error" in got.columns else 0
                self._commit(f"done-{name}", kind="done", generation=source["generation"], part=part, path=path, rows=got.count(), fails=bad)
                ran.append((source["generation"], part))
        return ran

    def results(self) -> DataFrame | None:
        got = self._read("done")
        return got.where("error is null").drop("error") if got is not None and "error" in got.columns else got

    def fails(self) -> DataFrame | None:
        got = self._read("done")
        return got.where("error is not null") if got is not None and "error" in got.columns else None

    def status(self, by: str) -> DataFrame:
        """(by, total, done, left): gathered rows of each group and those in finished parts."""
        over = [(c["generation"], c["part"]) for c in self.commits() if c["kind"] == "done"]
        done = self.spark.createDataFrame(over, "__generation int, __part int")
        parts = [self.spark.read.parquet(c["path"]).select(by, "__part", F.lit(c["generation"]).alias("__generation")) for c in self.commits() if c["kind"] == "gathered" and c["path"]]
        if not parts:
            raise ValueError("nothing has been gathered")
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        marked = rows.join(F.broadcast(done.withColumn("__done", F.lit(1))), ["__generation", "__part"], "left")  # a row a part
        out = marked.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count("__done").alias("done"))
        return out.withColumn("left", F.col("total") - F.col("done"))
