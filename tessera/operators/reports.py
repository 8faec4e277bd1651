"""Counts and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.names import reject_reason


def issuer_status(issuers: DataFrame, urls: DataFrame, done: DataFrame, cards: DataFrame) -> DataFrame:
    """(issuer_id, pos, total, done, cards, with_fees) of issuers that have URLs, in catalogue order."""
    n_urls = urls.join(done.select("url").distinct().withColumn("__done", F.lit(True)), "url", "left").groupBy("issuer_id")
    n_urls = n_urls.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce("__done", F.lit(False))).alias("done"))
    n_cards = cards.groupBy("issuer_id").agg(F.count(F.lit(1)).alias("cards"), F.count_if(F.col("fees").isNotNull()).alias("with_fees"))
    rows = issuers.select("issuer_id", "pos").join(n_urls, "issuer_id").join(n_cards, "issuer_id", "left")
    return rows.withColumn("cards", F.coalesce("cards", F.lit(0))).withColumn("with_fees", F.coalesce("with_fees", F.lit(0))).orderBy("pos")


def coverage(found: DataFrame, key: str = "issuer_id") -> DataFrame:
    """(key, urls, from_sitemap, sample, errors): distinct URLs, five first ones, four first errors.

    ``found``: key, url, is_sitemap, error, seq. URLs meet once per key before they are listed.
    """
    distinct = found.where(F.col("url").isNotNull()).groupBy(key, "url").agg(F.max(F.col("is_sitemap").cast("int")).alias("s"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("url"))
    per = distinct.withColumn("r", rank).groupBy(key).agg(
        F.count(F.lit(1)).alias("urls"), F.sum("s").alias("from_sitemap"), F.array_sort(F.collect_list(F.when(F.col("r") <= 5, F.col("url")))).alias("sample")
    )
    order = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    errors = found.where(F.col("error").isNotNull()).withColumn("r", order).where("r <= 4").groupBy(key)
    errors = errors.agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "error"))), lambda x: x["error"]).alias("errors"))
    return per.join(errors, key, "full").withColumn("urls", F.coalesce("urls", F.lit(0))).withColumn("from_sitemap", F.coalesce("from_sitemap", F.lit(0)))


def coverage_flag(rows: DataFrame) -> DataFrame:
    flag = F.when(F.col("urls") == 0, "ZERO").when(F.col("urls") <= 2, "LOW").otherwise("OK")
    return rows.withColumn("flag", flag).withColumn("shown", F.when(F.col("urls") == 0, "ZERO").otherwise(F.lpad(F.col("urls").cast("string"), 4, " ")))


def health_records(issuers: DataFrame) -> DataFrame:
    """(issuer_id, issuer_name, url_type, url) to be checked: listing URLs without fragments and sitemaps, each once an issuer and type.

    ``issuers``: issuer_id, issuer_name, list_urls, sitemap_url; nulls give no row.
    """
    head = ["issuer_id", "issuer_name"]
    lists = issuers.select(*head, F.lit("list_url").alias("url_type"), F.explode("list_urls").alias("url")).withColumn("url", F.substring_index("url", "#", 1))
    maps = issuers.select(*head, F.lit("sitemap_url").alias("url_type"), F.col("sitemap_url").alias("url"))
    return lists.unionByName(maps).where(F.col("url").isNotNull()).dropDuplicates(["issuer_id", "url_type", "url"])


def health_report(checked: DataFrame) -> DataFrame:
    """(level, category, reason, urls, issuers) of checked URLs: a row a reason, a row a category and one for all, from one pass.

    ``checked``: issuer_id, url, category, and what was found: error, status, phrase. A broken URL's reason is the first of them that tells.
    """
    status = F.when(F.col("status") >= 400, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    reason = F.when(F.col("category") == "BROKEN", F.coalesce("error", status, F.concat(F.lit("says: "), F.col("phrase"))))
    rows = checked.select("issuer_id", "category", reason.alias("reason"))
    by = [[F.col("category"), F.col("reason")], [F.col("category")], []]
    told = rows.groupingSets(by, "category", "reason").agg(
        F.count(F.lit(1)).alias("urls"), F.count_distinct("issuer_id").alias("issuers"), F.grouping_id().alias("__id")
    )
    level = F.when(F.col("__id") == 0, "reason").when(F.col("__id") == 1, "category").otherwise("all")
    return told.select(level.alias("level"), "category", "reason", "urls", "issuers")


def purge_reasons(cards: DataFrame) -> DataFrame:
    """Records with ``reason``: why a record is to be removed, null if it stays."""
    issuer = F.col("issuer_id")
    bad = F.when(F.coalesce(F.trim(issuer), F.lit("")) == "", "no issuer").when(F.lower(issuer) == "unknown", "unknown issuer").when(~issuer.rlike("^[a-z0-9_]+$"), "issuer id")
    return cards.withColumn("reason", F.coalesce(bad, F.concat(F.lit("name: "), reject_reason(F.col("card_name")))))


def merge_report(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of both, the new one of a key that both have."""
    from tessera.operators.store import upsert

    return upsert(old, new, key, keep=())
