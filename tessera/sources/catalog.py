"""Reading the issuer catalogue, curated lists, sitemaps, state files and what is scanned for new products."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import urls
from tessera.functions.text import has

ISSUERS = """issuer_id string, name string, type string, sitemap_url string, list_urls array<string>,
    detail_urls array<string>, cards array<struct<name:string,url:string,category:string,network:string>>,
    detail_link_pattern string, supplement_suffixes array<string>, max_urls int, pos int"""
FRONTIER = """url string, issuer_id string, issuer_name string, issuer_type string, is_listing boolean,
    prefetched_html string, force_card_name string, force_category string, force_network string,
    is_discovery boolean, discovered_via string, anchor string, seq long"""


def issuers(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The catalogue in file order (a YAML file with a list under ``issuers``); ids are text whatever YAML makes of them."""
    import yaml

    text = spark.read.text(path, wholetext=True).first().value  # one small configuration file
    rows = []
    for pos, x in enumerate(yaml.safe_load(text).get("issuers", [])):
        cards = [tuple(c.get(k) for k in ("name", "url", "category", "network")) for c in x.get("cards") or []]
        rows.append((str(x["id"]), x.get("name"), x.get("type"), x.get("sitemap_url"), x.get("list_urls") or [], x.get("detail_urls") or [], cards, x.get("detail_link_pattern"), x.get("supplement_suffixes") or [], x.get("max_urls"), pos))
    out = spark.createDataFrame(rows, ISSUERS)
    return out.where(F.col("issuer_id").isin(*only)) if only else out


def url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(issuer_id, url, pos) from one text file per issuer; blank lines and # comments are skipped."""
    files = spark.read.text(folder, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("issuer_id"), "value")
    lines = files.select("issuer_id", F.posexplode(F.split("value", "\n")).alias("pos", "url")).withColumn("url", F.trim("url", F.lit(" \t\r")))
    return lines.where((F.col("url") != "") & ~F.col("url").startswith("#"))


def sitemap_urls(xml: Column, pattern: str = "card") -> Column:
    """The locations of a sitemap that match the pattern."""
    found = F.transform(F.regexp_extract_all(xml, F.lit(r"<loc>(.*?)</loc>"), F.lit(1)), lambda u: F.trim(u))
    return F.filter(found, lambda u: has(u, pattern))


def frontier_sources(catalogue: DataFrame) -> list[DataFrame]:
    """Frontier rows that the catalogue itself gives: named products, detail pages, listing pages."""
    base = [F.col("issuer_id"), F.col("name").alias("issuer_name"), F.col("type").alias("issuer_type")]
    named = catalogue.select(*base, F.posexplode("cards").alias("seq", "c"))
    named = named.select("issuer_id", "issuer_name", "issuer_type", "seq", F.col("c.url").alias("url"), F.col("c.name").alias("force_card_name"), F.col("c.category").alias("force_category"), F.col("c.network").alias("force_network"), F.lit(False).alias("is_listing"))
    detail = catalogue.select(*base, F.posexplode("detail_urls").alias("seq", "url")).withColumn("is_listing", F.lit(False))
    listing = catalogue.select(*base, F.posexplode("list_urls").alias("seq", "url")).withColumn("is_listing", F.lit(True))
    return [named, detail, listing]


def json_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state file; an empty relation if there is none yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).option("multiLine", "true").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


@dataclass
class Discovery:
    """What is scanned for new products: seed pages in file order, words that make a link worth reading, and bounds."""

    seeds: DataFrame
    keywords: tuple[str, ...]
    links_per_seed: int
    depth: int


def discovery(spark: SparkSession, path: str) -> Discovery:
    """The discovery file: YAML with ``sources``, ``keywords`` and ``crawl`` (max_pages_per_source, max_depth)."""
    import yaml

    found = yaml.safe_load(spark.read.text(path, wholetext=True).first().value) or {}  # one small configuration file
    crawl = found.get("crawl") or {}
    seeds = spark.createDataFrame([(at, u) for at, u in enumerate(found.get("sources") or [])], "seed_pos long, url string")
    return Discovery(seeds, tuple(found.get("keywords") or ()), crawl.get("max_pages_per_source", 60), crawl.get("max_depth", 1))


def with_root(rows: DataFrame) -> DataFrame:
    return rows.withColumn("root_domain", urls.root_domain(F.col("url")))
