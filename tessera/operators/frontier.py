"""The URL frontier: union of sources, precedence, caps, link harvest. Every relation carries ``seq``, its order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import urls
from tessera.functions.text import rx

#: How many links a seed page gives and how many URLs an issuer may have.
LINKS_PER_SEED, URLS_PER_ISSUER = 60, 150


def first_wins(rows: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """The earliest row of each key. One shuffle on the key; ties by all columns are left to the caller's ``seq``."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(seq))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def listing_wins(rows: DataFrame) -> DataFrame:
    """One row a URL: the last listing row if there is one, else the first row; ``pos`` is where the URL came first."""
    listing = F.coalesce("is_listing", F.lit(False))
    key = Window.partitionBy("url")
    rank = F.row_number().over(key.orderBy(listing.desc(), F.when(listing, -F.col("seq")).otherwise(F.col("seq"))))
    return rows.withColumn("pos", F.min("seq").over(key)).withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def gather(*sources: DataFrame) -> DataFrame:
    """Sources in order of precedence as one relation; columns that a source lacks are null."""
    out = None
    for at, rows in enumerate(sources):
        rows = rows.withColumn("precedence", F.lit(at))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def by_precedence(rows: DataFrame) -> DataFrame:
    """Within an issuer the first of equal URLs by (precedence, seq) stays; listing rows always stay."""
    rank = F.row_number().over(Window.partitionBy("issuer_id", "url").orderBy("precedence", "seq"))
    return rows.withColumn("__rank", rank).where((F.col("__rank") == 1) | F.coalesce("is_listing", F.lit(False))).drop("__rank")


def cap_harvest(rows: DataFrame, added: DataFrame, cap: int = URLS_PER_ISSUER) -> DataFrame:
    """Harvested rows of an issuer in order, as many as its cap leaves beyond the ``added`` (issuer_id, n) ones."""
    rows = rows.join(added, "issuer_id", "left")
    rank = F.row_number().over(Window.partitionBy("issuer_id").orderBy("seq"))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= cap - F.coalesce("n", F.lit(0))).drop("__rank", "n")


def harvest(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page columns, link, pos): every link of every page, in page order."""
    return pages.select("*", F.posexplode(urls.links(F.col(html), F.col(url))).alias("pos", "link"))


def detail_links(links: DataFrame, issuers: DataFrame) -> DataFrame:
    """Links on their page's own site that match their issuer's pattern and are no assets."""
    pattern = F.concat(F.lit("(?i)"), F.coalesce("detail_link_pattern", F.lit("card")))
    rows = links.join(issuers.select("issuer_id", "detail_link_pattern"), "issuer_id")
    return rows.where(urls.same_site(F.col("link"), F.col("url")) & F.regexp_like("link", pattern) & urls.may_queue(F.col("link"))).drop("detail_link_pattern")


def relevant(blob: Column, keywords: tuple[str, ...]) -> Column:
    """Whether any keyword stands in the text: one pass over a constant array, never a join."""
    return F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(F.lower(blob), k))


def candidates(read: DataFrame, keywords: tuple[str, ...], most: int = LINKS_PER_SEED) -> DataFrame:
    """(link, seed_pos, seed, at, phase, pos, anchor): relevant links of pages (seed_pos, seed, at, url, html, text).

    A seed gives its first ``most`` links, pages in order of ``at``, and all inline mentions of its texts, which come after a page's links.
    A page sends at most ``most`` links, a task at most ``most`` of a seed (the rank's limit is taken before the shuffle), so a seed that
    links everything costs no task more than that. No keywords: nothing is relevant.
    """
    by = [F.col(c) for c in ("seed_pos", "seed", "at")]
    links = read.select(*by, F.posexplode(F.slice(urls.links(F.col("html"), F.col("url")), 1, most)).alias("pos", "link"))
    rank = F.row_number().over(Window.partitionBy("seed_pos").orderBy("at", "pos"))
    links = links.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank").withColumns({"phase": F.lit(0), "anchor": F.lit("")})
    mention = rx(r"\[([^\]]{4,120})\]\((https?://[^)\s]+)\)")
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(mention), F.lit(1)).alias("anchor"), F.regexp_extract_all("text", F.lit(mention), F.lit(2)).alias("link"))
    inline = read.select(*by, F.posexplode(both).alias("pos", "m")).select(*by, "pos", F.col("m.link").alias("link"), F.lit(1).alias("phase"), F.col("m.anchor").alias("anchor"))
    rows = links.unionByName(inline).where(relevant(F.concat_ws(" ", "link", "anchor"), keywords) if keywords else F.lit(False))
    rank = F.row_number().over(Window.partitionBy("link").orderBy("seed_pos", "at", "phase", "pos"))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def discovery(seeds: DataFrame, keywords: tuple[str, ...], most: int = LINKS_PER_SEED) -> DataFrame:
    """(link, seed, anchor): the candidates of seed pages (seed_pos, url, html), mentions read from the html as it stands."""
    read = seeds.select("seed_pos", F.col("url").alias("seed"), F.array(F.lit(0)).alias("at"), "url", "html", F.col("html").alias("text"))
    return candidates(read, keywords, most).select("link", "seed", "anchor")


def scan(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], keywords: tuple[str, ...], keep: Callable[[DataFrame, str], DataFrame], depth: int = 1, most: int = LINKS_PER_SEED) -> DataFrame:
    """(link, seed, anchor, hop) found from seeds (seed_pos, url) in ``depth`` rounds: pages of a round's links are the next round's.

    ``fetch(rows)`` gives (url, html, text) of rows (url), a join with stored pages or a connector; pages without an answer give nothing.
    A link counts in the first round that finds it; no page is read twice. ``keep(df, name)`` writes each round, so that its pages are read once.
    A round is a join, a capped harvest and an anti-join with what is known; nothing of it passes through the driver.
    """
    front = seeds.groupBy("url").agg(F.min("seed_pos").alias("seed_pos")).withColumns({"seed": F.col("url"), "at": F.array(F.lit(0))})
    out, asked = None, seeds.select(F.col("url").alias("link"))
    for hop in range(1, depth + 1):
        fresh = candidates(front.join(fetch(front.select("url")), "url"), keywords, most)
        if out is not None:
            fresh = fresh.join(out.select("link"), "link", "left_anti")
        fresh = keep(fresh.withColumn("hop", F.lit(hop)), f"hop-{hop}")
        out = fresh if out is None else out.unionByName(fresh)
        front = fresh.join(asked, "link", "left_anti").select("seed_pos", "seed", F.concat("at", F.array("phase", "pos")).alias("at"), F.col("link").alias("url"))
    return out.select("link", "seed", "anchor", "hop")


def to_fetch(frontier: DataFrame) -> DataFrame:
    """Rows to fetch: those with a forced name, and those that pass the URL filter."""
    return frontier.where(F.col("force_card_name").isNotNull() | urls.may_fetch(F.col("url"), F.coalesce("is_discovery", F.lit(False))))


def stop_after(rows: DataFrame, count: str, most: int) -> DataFrame:
    """Rows in ``seq`` order until ``count`` has reached ``most`` before them (the last one may overshoot).

    Sums by block of rows first, so that only block totals pass through one window.
    """
    rows = rows.withColumn("__block", F.floor(F.col("seq") / 4096))
    blocks = rows.groupBy("__block").agg(F.sum(count).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(blocks.select("__block", before.alias("__before")), "__block")
    inside = F.coalesce(F.sum(count).over(Window.partitionBy("__block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__n", F.col("__before") + inside).where(F.col("__n") < most).drop("__block", "__before", "__n")
