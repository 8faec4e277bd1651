"""Tables of record on plain Parquet: merge, delete, ledger, archive. All are joins; nothing is looked up row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.urls import may_queue


def upsert(old: DataFrame, new: DataFrame, key: str = "card_id", keep: tuple[str, ...] = ("first_seen_at",), fill_nulls: bool = False) -> DataFrame:
    """``new`` rows replace ``old`` ones of their key, but for ``keep``, which stay as first seen.

    With ``fill_nulls`` a null of the new row does not hide the old value.
    """
    columns = new.columns
    before = old.select(key, *[F.col(c).alias(f"__{c}") if c in old.columns else F.lit(None).alias(f"__{c}") for c in columns if c != key])
    rows = new.withColumn("__new", F.lit(True)).join(before, key, "full")

    def value(c: str):
        now, then = F.col(c), F.col(f"__{c}")
        if c in keep:
            return F.coalesce(then, now).alias(c)
        if fill_nulls:
            return F.coalesce(now, then).alias(c)
        return F.when(F.col("__new"), now).otherwise(then).alias(c)

    return rows.select(*[F.col(c) if c == key else value(c) for c in columns])


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys.select(key), key, "left_anti")


def mark_sources(ledger: DataFrame, pages: DataFrame, run_ts: str) -> DataFrame:
    """The ledger (url, last_seen_at, raw_text_sha256, etag) after a run over ``pages`` (source_url, sha, etag)."""
    seen = pages.select(F.col("source_url").alias("url"), F.lit(run_ts).alias("last_seen_at"), F.col("sha").alias("raw_text_sha256"), "etag")
    return upsert(ledger, seen.dropDuplicates(["url"]), "url", keep=())


def archive(pages: DataFrame, path: str, day: str) -> None:
    """Raw pages of a day, compressed, under a key that any process computes alike."""
    rows = pages.select(F.sha2("source_url", 256).alias("key"), "source_url", "html").withColumn("ingest_date", F.lit(day))
    rows.write.mode("append").partitionBy("ingest_date").option("compression", "gzip").parquet(path)


def ensure_table(spark, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def publish(rows: DataFrame, path: str) -> None:
    """Records as JSON lines without nulls."""
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "true"}).alias("value")).write.mode("overwrite").text(path)


def write_url_lists(urls: DataFrame, path: str, parts: int | None = None) -> None:
    """A folder of text files for each issuer: its distinct URLs in order, over as many files as its range needs.

    Rows are ranged by (issuer, URL), so an issuer of any size is spread over tasks, and its files, by name, follow each other.
    Null issuers or URLs are left out.
    """
    rows = urls.select("issuer_id", "url").where("issuer_id is not null and url is not null").distinct()
    ranged = rows.repartitionByRange(*([parts] if parts else []), "issuer_id", "url").sortWithinPartitions("issuer_id", "url")
    ranged.select("issuer_id", F.col("url").alias("value")).write.mode("overwrite").partitionBy("issuer_id").text(path)


def read_url_lists(spark: SparkSession, path: str) -> DataFrame:
    """(issuer_id, url) of written lists; ids stay text. Order within an issuer is that of the URL."""
    return spark.read.schema("value string, issuer_id string").text(path).select("issuer_id", F.col("value").alias("url"))


def list_rows(lists: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Frontier rows of curated lists: URLs of issuers that the catalogue has, once each, comments and blank lines left out."""
    rows = lists.withColumn("url", F.trim("url")).where((F.col("url") != "") & ~F.col("url").startswith("#") & may_queue(F.col("url")))
    known = catalogue.select("issuer_id", F.col("name").alias("issuer_name"), F.col("type").alias("issuer_type"))
    return rows.select("issuer_id", "url").distinct().join(known, "issuer_id").withColumn("is_listing", F.lit(False))
