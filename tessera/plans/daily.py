"""The daily run as one job: stages with named tables, all of which become visible at once.

Every stage writes its table into a folder of the run. A version is a manifest that names the folder of each table; it
appears by one rename at the end of the run, so that readers see all tables of a run or none, and a run that dies
leaves folders that nobody reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import cascade, changes, extract, frontier, migrate, names, pages, registry, reports, resolve, store
from tessera.session import spread

Fetch = Callable[[DataFrame], DataFrame]
LEDGER = "url string, last_seen_at string, raw_text_sha256 string, etag string"
#: Places of a page's records within the order of the run: page number times this, plus the record's place.
PLACES = 2**20


class Versions:
    """Tables of runs under ``folder``, which driver and executors share. Two runs at once: the later commit fails."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def latest(self) -> int:
        """The number of the newest version, 0 before the first."""
        at = self._hadoop.Path(f"{self.folder}/versions")
        if not self._fs.exists(at):
            return 0
        return max((int(f.getPath().getName().removesuffix(".json")) for f in self._fs.listStatus(at)), default=0)

    def tables(self, version: int | None = None) -> dict[str, str]:
        """The folder of each table of a version."""
        version = self.latest() if version is None else version
        if not version:
            return {}
        return json.loads(self.spark.read.text(f"{self.folder}/versions/{version:08d}.json", wholetext=True).first().value)

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        path = self.tables(version).get(name)
        return self.spark.read.parquet(path) if path else None

    def begin(self) -> Staged:
        return Staged(self, self.latest(), f"{self.folder}/runs/{uuid.uuid4().hex}", {})

    def publish(self, number: int, tables: dict[str, str]) -> None:
        at, to = self._hadoop.Path(f"{self.folder}/_{uuid.uuid4().hex}"), self._hadoop.Path(f"{self.folder}/versions/{number:08d}.json")
        self._fs.mkdirs(to.getParent())
        out = self._fs.create(at)
        out.write(json.dumps(tables).encode())
        out.close()
        if self._fs.exists(to) or not self._fs.rename(at, to):
            raise RuntimeError(f"version {number} was committed by another run")


@dataclass
class Staged:
    """One run's tables, written but not yet seen by readers."""

    versions: Versions
    before: int
    folder: str
    tables: dict[str, str]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table of this run and reads it again; lineage ends here, and lost executors cost no earlier stage."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        self.tables[name] = path
        return self.versions.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> int:
        """All tables of this run, with those of the version before that it did not write, as one new version."""
        self.versions.publish(self.before + 1, {**self.versions.tables(self.before), **self.tables})
        return self.before + 1


@dataclass(frozen=True)
class Options:
    """``first`` bounds the frontier, ``most`` the records; both None: all. ``force`` reads unchanged pages again and purges first."""

    first: int | None = None
    most: int | None = None
    force: bool = False
    deepen: bool = False


def _supplemented(kept: DataFrame, suffixes: DataFrame, fetch: Fetch, staged: Staged) -> DataFrame:
    """Pages with supplement texts; those of listing and prefetched pages are not asked for."""
    own = F.col("prefetched_html").isNull() & ~F.coalesce("is_listing", F.lit(False))
    asked = kept.where(own).join(suffixes, "issuer_id").select(F.concat(F.rtrim("url", F.lit("/")), "suffix").alias("url"), F.lit(None).cast("string").alias("prefetched_html"))
    texts = staged.keep(fetch(asked.distinct()).select("url", "text"), "supplements")
    return pages.with_supplements(kept.where(own), suffixes, texts).unionByName(kept.where(~own))


def _until(found: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """Pages (source_url) in order until ``most`` records were found before them."""
    n = found.groupBy("source_url").agg(F.count(F.lit(1)).alias("__found"))
    counted = rows.select("source_url", "seq").join(n, "source_url", "left").withColumn("__found", F.coalesce("__found", F.lit(0)))
    return frontier.stop_after(counted, "__found", most).select("source_url")


def run_daily(versions: Versions, rows: DataFrame, fetch: Fetch, run_ts: str, suffixes: DataFrame | None = None, plug_ins: registry.Registry | None = None, provider: cascade.Provider | None = None, options: Options = Options()) -> int:  # noqa: B008  frozen
    """One day over frontier ``rows`` (url, issuer_id, issuer_name, is_listing, force_*, is_discovery, prefetched_html, seq); the new version's number.

    ``fetch`` maps (url, prefetched_html) to (url, html, text, etag, ok). Tables of a version: ``frontier``, ``fetched``, ``pages``,
    ``attempts``, ``found``, ``rejected``, ``cards`` (all records known), ``catalogue`` (this run's, near copies of names collapsed),
    ``published``, ``changes``, ``added``, ``ledger`` and, with ``force``, ``purged``.
    Pages that no provider answered and pages past ``options.most`` stay out of the ledger and come again. Rows without a URL, and null
    ``seq``, are left out; an empty frontier gives empty tables and keeps what is known.
    """
    plug_ins, staged = plug_ins or registry.Registry(), versions.begin()
    spark = versions.spark
    known, seen = versions.read("cards"), versions.read("ledger")
    seen = spark.createDataFrame([], LEDGER) if seen is None else seen

    front = rows.where("url is not null and seq is not null").transform(frontier.listing_wins).drop("pos").transform(frontier.to_fetch).transform(plug_ins.wanted)
    if options.first is not None:
        front = front.orderBy("seq").limit(options.first)
    front = staged.keep(front, "frontier")

    got = staged.keep(fetch(front.select("url", "prefetched_html")).select("url", "html", "text", "etag", "ok"), "fetched")
    kept = front.join(got.where("ok").select("url", F.col("text").alias("markdown"), "html", "etag"), "url")
    kept = kept.where(~pages.near_empty(F.col("markdown")) & ~pages.soft_404(F.col("markdown")))
    if suffixes is not None:
        kept = _supplemented(staged.keep(kept, "usable"), suffixes, fetch, staged)
    kept = kept.withColumn("sha", F.sha2("markdown", 256))
    if not options.force:
        kept = pages.unchanged(kept, seen)
    kept = staged.keep(kept.withColumnRenamed("url", "source_url"), "pages")

    out = cascade.extract_pages(kept, run_ts, staged.keep, plug_ins, extract.dealt_cards, provider=provider, deepen=options.deepen)
    found = extract.with_ids(out.cards, run_ts)
    order = kept.select("source_url", F.col("seq").alias("__seq"), "sha")
    found = found.drop("sha").join(order, "source_url").withColumn("seq", (F.col("__seq") * PLACES + F.col("pos")).cast("long")).drop("__seq", "pos")
    found = staged.keep(found.withColumn("reason", names.reject_reason(F.col("card_name"))), "found")
    good = found.where("reason is null").drop("reason")
    attempts = out.attempts
    if options.most is not None:
        done = staged.keep(_until(good, kept, options.most), "done")
        good, attempts = good.join(done, "source_url", "left_semi"), attempts.join(done, "source_url", "left_semi")
    settled = kept.join(cascade.settled(attempts), ["source_url", "sha"], "left_semi")

    good = staged.keep(resolve.fullest(good).drop("pos"), "records")
    copies = resolve.collapse_names(good.select("issuer_id", "card_name", "seq"))
    catalogue = staged.keep(good.join(copies.where("seq = kept_by").select("seq"), "seq", "left_semi"), "catalogue")
    good = good.drop("seq")
    old = good.limit(0) if known is None else known
    if options.force:
        judged = staged.keep(reports.purge_reasons(old), "judged")
        staged.keep(judged.where("reason is not null").select("card_id", "card_name", "issuer_id", "reason"), "purged")
        old = judged.where("reason is null").drop("reason")
    cards = staged.keep(store.upsert(old, good), "cards")
    staged.keep(found.where("reason is not null").select("source_url", "card_name", "reason"), "rejected")
    staged.keep(migrate.validated(migrate.to_v2(spread(cards, "card_id"))), "published")
    staged.keep(changes.changes(old, good, run_ts), "changes")
    staged.keep(changes.appeared(old, good), "added")
    staged.keep(store.mark_sources(seen, settled, run_ts), "ledger")
    return staged.commit()
