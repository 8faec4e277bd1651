"""Fetched pages: content filters, supplements, change detection by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.html import plain_text
from tessera.functions.text import first_line
from tessera.session import bounded_batches

LEAST_CHARS = 200
#: Phrases in the first line of a page that is missing behind a good status.
SOFT_404 = ("page not found", "404 error", "error 404", "page doesn't exist", "page does not exist")
#: Phrases in a body that tell of an error, the strong ones whatever the status.
ERROR_PHRASES = (
    "404", "not found", "page does not exist", "page not found", "access denied", "coming soon", "under construction",
    "forbidden", "503 service", "502 bad gateway", "temporarily unavailable", "no longer available",
    "this page has moved", "we couldn't find", "cannot be found", "doesn't exist", "error occurred",
    "something went wrong", "internal server error",
)
STRONG_PHRASES = (
    "page does not exist", "page not found", "cannot be found", "doesn't exist", "access denied", "we couldn't find",
    "this page has moved", "no longer available", "temporarily unavailable", "internal server error",
    "something went wrong",
)


def near_empty(text: Column, least: int = LEAST_CHARS) -> Column:
    return F.length(F.coalesce(text, F.lit(""))) < least


def soft_404(text: Column) -> Column:
    line = F.lower(first_line(F.coalesce(text, F.lit("")), 200))
    return F.exists(F.array(*[F.lit(p) for p in SOFT_404]), lambda p: F.contains(line, p))


def usable(pages: DataFrame, text: str = "text") -> DataFrame:
    return pages.where(~near_empty(F.col(text)) & ~soft_404(F.col(text)))


def to_pages(fetched: DataFrame) -> DataFrame:
    """Bronze rows (url, html, ...) to pages with plain text and its hash."""
    bounded_batches(fetched.sparkSession)
    return fetched.withColumn("markdown", plain_text(F.col("html"))).withColumn("sha", F.sha2("markdown", 256))


def unchanged(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pages whose (url, hash) the ledger has not seen."""
    return pages.join(ledger.select("url", F.col("raw_text_sha256").alias("sha")), ["url", "sha"], "left_anti")


def with_supplements(pages: DataFrame, suffixes: DataFrame, fetched: DataFrame) -> DataFrame:
    """Pages with the texts of their issuer's supplement pages appended, in suffix order.

    ``suffixes``: (issuer_id, suffix, pos); ``fetched``: (url, text). Pages that state a fee already, and
    supplements that are short or missing, are left out before the joins.
    """
    stated = F.col("markdown").rlike(r"(?iU)(joining|annual|renewal)[^\n]{0,40}(₹|rs\.?|inr)\s*\d")
    asked = pages.where(~stated).select("url", "issuer_id").join(suffixes, "issuer_id").withColumn("extra", F.concat(F.rtrim("url", F.lit("/")), "suffix"))
    texts = fetched.where(~near_empty(F.col("text")) & ~soft_404(F.col("text"))).select(F.col("url").alias("extra"), "text")
    label = F.upper(F.replace(F.trim("suffix", F.lit("/")), F.lit("-"), F.lit(" ")))
    parts = asked.join(texts, "extra").select("url", F.struct("pos", F.concat(F.lit("\n\n## "), label, F.lit("\n"), "text").alias("part")).alias("p"))
    parts = parts.groupBy("url").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["part"]), "").alias("extra"))
    return pages.join(parts, "url", "left").withColumn("markdown", F.concat("markdown", F.coalesce("extra", F.lit("")))).drop("extra")


def content_copies(pages: DataFrame, text: str = "text") -> DataFrame:
    """(sha, n) of texts that occur more than once."""
    return pages.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def error_phrase(body: Column, status: Column) -> Column:
    """The first phrase, in list order, that marks the body as an error page."""
    sample = F.lower(F.substring(body, 1, 50_000))
    listed = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(p in STRONG_PHRASES).alias("strong")) for p in ERROR_PHRASES])
    found = F.filter(listed, lambda x: F.contains(sample, x["p"]) & (x["strong"] | (status != 200)))
    return F.try_element_at(found, F.lit(1))["p"]


def health(error: Column, status: Column, phrase: Column, redirected: Column) -> Column:
    """BROKEN, REDIRECTED or OK."""
    broken = error.isNotNull() | F.coalesce(status >= 400, F.lit(False)) | phrase.isNotNull()
    return F.when(broken, "BROKEN").when(redirected, "REDIRECTED").otherwise("OK")


def latest(rows: DataFrame, key: str, seq: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(seq).desc()))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
