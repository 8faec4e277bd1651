"""Extraction step by step: an issuer's own extractor, the rules, then a provider, with what each page came to.

A page's state only rises: retry (no provider answered), empty (seen, nothing there), ok. Attempts are appended and
never changed; what a page has come to is the highest state among them, whatever their order and however often
the same run reports, so that runs may be repeated, cut short or merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import enrich, extract, resolve
from tessera.operators.pages import near_empty
from tessera.operators.registry import Extractor, Registry

STATES = ("retry", "empty", "ok")
ATTEMPTS = "source_url string, sha string, run_ts string, step string, status string"
Keep = Callable[[DataFrame, str], DataFrame]
Provider = Callable[[list[str]], list[str | None]]


def level(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATES]), status)


def standing(attempts: DataFrame) -> DataFrame:
    """(source_url, sha, status, step, n_runs, last_run): what every version of a page has come to."""
    best = F.max(F.struct(level(F.col("status")).alias("level"), "run_ts", "step", "status"))
    rows = attempts.groupBy("source_url", "sha").agg(best.alias("b"), F.count_distinct("run_ts").cast("long").alias("n_runs"), F.max("run_ts").alias("last_run"))
    return rows.select("source_url", "sha", "b.status", "b.step", "n_runs", "last_run")


def settled(attempts: DataFrame) -> DataFrame:
    """(source_url, sha) of page versions that need no further run."""
    return attempts.where(F.col("status") != STATES[0]).select("source_url", "sha").distinct()


def due(pages: DataFrame, attempts: DataFrame) -> DataFrame:
    """Pages that no run has settled in this version."""
    return pages.join(settled(attempts), ["source_url", "sha"], "left_anti")


@dataclass
class Outcome:
    cards: DataFrame
    attempts: DataFrame


def _asked(pages: DataFrame, provider: Provider, record: str, keep: Keep, name: str) -> tuple[DataFrame, DataFrame]:
    """(answers with their page's url, trusted records of them); a provider is asked once, as answers are kept."""
    answers = keep(enrich.ask(enrich.prompts(pages), provider).select("source_url", "answer"), f"{name}-answers")
    return answers, keep(enrich.trusted(enrich.parsed(answers, record), pages), f"{name}-records")


def filled_from(cards: DataFrame, records: DataFrame) -> DataFrame:
    """Rule-made ``cards`` with gaps filled from the record of their page whose name shares most words with theirs.

    ``records``: source_url, pos, card. A page's only record is taken whatever its name.
    """
    mine = cards.withColumn("__id", F.struct("source_url", F.col("pos").cast("long")))
    theirs = records.select(F.struct("source_url", F.col("pos").cast("long")).alias("other_id"), "source_url", F.col("pos").alias("seq"), "card", F.col("card.card_name").alias("card_name"))
    pairs = resolve.best_match(mine.select(F.col("__id").alias("id"), "source_url", "card_name"), theirs.drop("card"), "source_url")
    kinds = {f.name for f in records.schema["card"].dataType.fields}
    extra = pairs.join(theirs, "other_id").select(F.col("id").alias("__id"), *[F.col(f"card.{f}").alias(f) for f in enrich.DETAILS if f in kinds])
    return enrich.fill_records(mine, extra, "__id").drop("__id")


def extract_pages(pages: DataFrame, run_ts: str, keep: Keep, plug_ins: Registry | None = None, rules: Extractor = extract.cards, provider: Provider | None = None, deepen: bool = False) -> Outcome:
    """Records of ``pages`` and an attempt for each of them.

    Nearly empty pages are seen. Pages of an issuer with an extractor end with what it finds. For others the rules
    come first; with ``deepen`` the provider fills gaps of their records on pages that list nothing. Where the rules
    find nothing, a listing page is seen (its products have pages of their own) and any other goes to the
    provider: no answer leaves it for another run. Without a provider such a page is seen.
    """
    plug_ins = plug_ins or Registry()
    own = F.coalesce(F.col("issuer_id").isin(*plug_ins.extractors), F.lit(False))
    able = pages.where(~near_empty(F.col("markdown")))
    registered = able.where(own)
    ruled = able.where(~own)
    by_rules = keep(rules(ruled), "by-rules")
    by_own = by_rules.limit(0)
    if plug_ins.extractors:
        by_own = keep(plug_ins.extract(registered, rules), "by-extractor")
    hit = by_rules.select("source_url").distinct()
    missed = ruled.join(hit, "source_url", "left_anti")
    listing = F.coalesce(F.col("is_listing"), F.lit(False))

    def tried(rows: DataFrame, step: str, status: Column | str) -> DataFrame:
        status = F.lit(status) if isinstance(status, str) else status
        return rows.select("source_url", "sha", F.lit(run_ts).alias("run_ts"), F.lit(step).alias("step"), status.alias("status"))

    found = by_own.select("source_url").distinct().withColumn("__found", F.lit(True))
    attempts = tried(pages.where(near_empty(F.col("markdown"))), "short", "empty")
    attempts = attempts.unionByName(tried(registered.join(found, "source_url", "left"), "extractor", F.when(F.col("__found"), "ok").otherwise("empty")))
    attempts = attempts.unionByName(tried(ruled.join(hit, "source_url", "left_semi"), "rules", "ok"))
    attempts = attempts.unionByName(tried(missed.where(listing), "listing", "empty"))
    last = missed.where(~listing)
    cards = by_rules
    if provider is None:
        attempts = attempts.unionByName(tried(last, "rules", "empty"))
    else:
        record = by_rules.drop("source_url", "pos", "sha").schema.simpleString()
        if deepen:
            plain = ruled.where(~listing).join(hit, "source_url", "left_semi")
            cards = keep(filled_from(by_rules, _asked(plain, provider, record, keep, "deepen")[1]), "deepened")
        answers, records = _asked(last, provider, record, keep, "asked")
        n = records.groupBy("source_url").agg(F.count(F.lit(1)).alias("__n"))
        judged = last.join(answers, "source_url").join(n, "source_url", "left")
        attempts = attempts.unionByName(tried(judged, "provider", enrich.status(F.col("answer"), F.coalesce("__n", F.lit(0)))))
        more = records.join(last.select("source_url", "sha"), "source_url")
        parts = [c for c in by_rules.columns if c not in ("source_url", "pos", "sha", "issuer_id")]
        cards = cards.unionByName(more.select("source_url", F.col("pos").cast(by_rules.schema["pos"].dataType).alias("pos"), "sha", "issuer_id", *[F.col(f"card.{c}").alias(c) for c in parts]))
    return Outcome(cards.unionByName(by_own, allowMissingColumns=True), keep(attempts, "attempts"))
