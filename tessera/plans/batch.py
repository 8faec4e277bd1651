"""The daily run as one plan: frontier rows and fetched pages in, tables of record out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import changes, extract, frontier, migrate, names, pages, registry, resolve, store
from tessera.session import spread


@dataclass
class Run:
    cards: DataFrame
    rejected: DataFrame
    published: DataFrame
    changes: DataFrame
    ledger: DataFrame


def run_batch(fetched: DataFrame, known: DataFrame, ledger: DataFrame, run_ts: str, keep: Callable[[DataFrame, str], DataFrame], plug_ins: registry.Registry | None = None, force: bool = False) -> Run:
    """``fetched``: frontier columns, html, etag, seq. ``known``: v1 records of earlier runs.

    ``keep(df, name)`` writes a relation and reads it again: pages and extracted records feed several outputs,
    and must not be made anew for each.
    """
    rows = fetched.transform(frontier.listing_wins).drop("pos").transform(frontier.to_fetch)
    rows = pages.to_pages(rows).where(~pages.near_empty(F.col("markdown")) & ~pages.soft_404(F.col("markdown")))
    rows = rows.withColumnRenamed("url", "source_url")
    if not force:
        seen = ledger.select(F.col("url").alias("source_url"), F.col("raw_text_sha256").alias("sha"))
        rows = rows.join(seen, ["source_url", "sha"], "left_anti")
    rows = keep(rows, "pages")
    found = (plug_ins or registry.Registry()).extract(rows, extract.dealt_cards)
    order = rows.select("source_url", F.col("seq").alias("__seq"))
    found = extract.with_ids(found, run_ts).join(order, "source_url", "left").withColumn("seq", F.struct("__seq", "pos")).drop("__seq")
    found = keep(found, "found")
    good = resolve.fullest(found.where(names.valid(F.col("card_name")))).drop("pos", "seq")
    old = known.select(*[c for c in good.columns if c in known.columns])
    merged = keep(store.upsert(old, good), "cards")
    return Run(
        cards=merged,
        rejected=found.withColumn("reason", names.reject_reason(F.col("card_name"))).where("reason is not null").select("source_url", "card_name", "reason"),
        published=migrate.validated(migrate.to_v2(spread(merged, "card_id"))),
        changes=changes.changes(known, good, run_ts),
        ledger=store.mark_sources(ledger, rows, run_ts),
    )
