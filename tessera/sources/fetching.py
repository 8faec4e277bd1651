"""Fetching of pages: calls spaced by lanes, and a router in which only what one route failed goes to the next.

The transport, ``(url, headers, timeout) -> (status, body, etag)``, is passed in; it raises where there is no answer at all.
"""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import urls
from tessera.functions.html import plain_text

Transport = Callable[[str, dict[str, str], float], tuple[int, str, str | None]]
Keep = Callable[[DataFrame, str], DataFrame]

#: Hosts that the reader proxy cannot render.
BYPASS_HOSTS = (
    "www.axis.bank.in", "axis.bank.in", "www.unionbankofindia.bank.in", "www.indianbank.in", "bankofmaharashtra.bank.in",
    "centralbank.bank.in", "www.cityunionbank.com", "www.dhan.bank.in", "www.dbs.bank.in", "equitas.bank.in",
    "www.jana.bank.in", "www.ujjivansfb.bank.in", "www.nainitalbank.bank.in", "www.airtelpayments.bank.in",
    "www.fino.bank.in", "www.americanexpress.com", "americanexpress.com",
)
#: Domains that are asked through the proxy only.
STRICT_DOMAINS = (
    "hdfcbank.com", "icicibank.com", "idfcfirstbank.com", "yesbank.in", "axisbank.com", "sbi.co.in", "sbicard.com",
    "bandhanbank.com", "southindianbank.com", "federalbank.co.in", "idbibank.in", "unionbankofindia.co.in",
    "bobcard.co.in", "cred.club", "jupiter.money", "fi.money", "super.money", "amazon.in", "goniyo.com", "tataneu.com",
    "bajajfinserv.in", "bank.in", "hsbc.co.in", "americanexpress.com", "sc.com", "cityunionbank.com", "paisabazaar.com",
    "stashfin.com",
)
#: What a proxy writes at the head of a page that is missing behind a good status, and how far in.
PROXY_SOFT_404, PROXY_HEAD = ("page not found", "warning: target url returned error 404", "error 404"), 300
SOFT_404 = "soft 404"
ANSWER = "url string, html string, status_code int, etag string, error string"


@dataclass(frozen=True)
class Proxy:
    """A reader proxy: the page's URL is appended to ``prefix``. ``gap_s`` holds for the proxy as a whole, over the cluster."""

    prefix: str
    headers: dict[str, str] = field(default_factory=lambda: {"Accept": "text/markdown,text/plain,*/*"})
    gap_s: float = 3.5
    pause_s: float = 10.0


@dataclass(frozen=True)
class Direct:
    """Calls to the sites themselves. ``gap_s`` holds for a host, over the cluster."""

    headers: dict[str, str] = field(default_factory=lambda: {"Accept": "text/html,application/xhtml+xml,*/*;q=0.8", "Accept-Language": "en-US,en;q=0.5"})
    gap_s: float = 0.4
    attempts: int = 2


def http(url: str, headers: dict[str, str], timeout: float) -> tuple[int, str, str | None]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "tessera", **headers}), timeout=timeout) as got:
            return got.status, got.read().decode("utf-8", "replace"), got.headers.get("ETag")
    except urllib.error.HTTPError as error:
        return error.code, "", None


def lanes(rows: DataFrame, site: Column, gap_s: float, width: int, most: int | None = 1000) -> DataFrame:
    """Rows dealt to ``width`` partitions, each with the ``__gap`` that its calls to a ``__site`` keep.

    A site lies in one lane. One with more than ``most`` rows lies in several, each with its share of the rate, so that slow
    answers overlap and no task gets a hot site whole; the calls to a site still come no faster than one in ``gap_s``.
    With no ``most`` every site lies in all lanes and nothing is counted. A task that Spark runs again calls again, at the same pace.
    Rows without a site share one.
    """
    rows = rows.withColumn("__site", F.coalesce(site, F.lit("")))
    if most is None:
        rows = rows.withColumn("__ways", F.lit(width))
    else:
        rows = _ways(rows, width, most)
    way = F.pmod(F.xxhash64("url"), F.col("__ways"))
    rows = rows.withColumn("__lane", F.pmod(F.pmod(F.xxhash64("__site"), F.lit(width)) + way, F.lit(width)).cast("int"))
    rows = rows.withColumn("__gap", F.col("__ways") * F.lit(float(gap_s)))
    return rows.repartitionById(width, "__lane").sortWithinPartitions(F.xxhash64("url", F.lit("order")))


def _ways(rows: DataFrame, width: int, most: int) -> DataFrame:
    """How many lanes a row's site has: only hot sites are joined, at most one for each ``most`` rows there are."""
    hot = rows.groupBy("__site").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    hot = hot.select("__site", F.least(F.ceil(F.col("n") / most), F.lit(width)).cast("int").alias("__ways"))
    return rows.join(hot, "__site", "left").withColumn("__ways", F.coalesce("__ways", F.lit(1)))


def _paced(ask: Callable[[str, float], tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A lane's work: ``ask(url, gap)`` for each row, a gap after the last call to the same site."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free: dict[str, float] = {}  # when a site may be called again
        for batch in batches:
            rows = []
            for url, site, gap in zip(*(batch[c].to_pylist() for c in ("url", "__site", "__gap"))):
                time.sleep(max(0.0, free.get(site, 0.0) - time.monotonic()))
                start = time.monotonic()
                got, last = ask(url, gap)
                free[site] = max(start, last) + gap
                if len(free) > 1024:
                    now = time.monotonic()
                    free = {s: at for s, at in free.items() if at > now}
                rows.append((url, *got))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()))], names=["url", "html", "status_code", "etag", "error"])

    return run


def by_proxy(rows: DataFrame, proxy: Proxy, transport: Transport = http, width: int = 8, timeout_s: float = 30.0) -> DataFrame:
    """Answers of the proxy. Its error is ``SOFT_404`` where it gives a missing page with a good status."""

    def ask(url: str, gap: float) -> tuple[tuple, float]:
        start = time.monotonic()
        try:
            status, body, _ = transport(proxy.prefix + (url or ""), proxy.headers, timeout_s)
        except Exception as error:  # noqa: BLE001  a page that fails is a row, not the end of the run
            return (None, None, None, f"{type(error).__name__}: {error}"), start
        if status == 429:
            time.sleep(proxy.pause_s)
        if status != 200 or not body:
            return (None, status, None, f"proxy status {status}"), start
        if any(p in body[:PROXY_HEAD].lower() for p in PROXY_SOFT_404):
            return (None, 404, None, SOFT_404), start
        return (body, status, None, None), start

    dealt = lanes(rows.select("url"), F.lit("proxy"), proxy.gap_s, width, most=None)
    return dealt.select("url", "__site", "__gap").mapInArrow(_paced(ask), ANSWER)


def direct(rows: DataFrame, how: Direct, transport: Transport = http, width: int = 8, timeout_s: float = 30.0) -> DataFrame:
    """Answers of the sites themselves; a call that fails is made again after a growing pause of at least the gap."""

    def ask(url: str, gap: float) -> tuple[tuple, float]:
        said, start = (None, None, None, "not asked"), time.monotonic()
        for attempt in range(how.attempts):
            if attempt:
                time.sleep(max(gap, min(8.0, 2.0**attempt) * (0.5 + random.random() / 2)))
            start = time.monotonic()
            try:
                status, body, etag = transport(url, how.headers, timeout_s)
            except TimeoutError as error:
                said = (None, 408, None, f"TimeoutError: {error}")
            except Exception as error:  # noqa: BLE001
                said = (None, None, None, f"{type(error).__name__}: {error}")
            else:
                if status < 400:
                    return (body, status, etag, None), start
                said = (None, status, None, f"status {status}")
        return said, start

    dealt = lanes(rows.select("url"), urls.host(F.col("url")), how.gap_s, width)
    return dealt.select("url", "__site", "__gap").mapInArrow(_paced(ask), ANSWER)


def routed(frontier: DataFrame, proxy: Proxy, how: Direct, keep: Keep, transport: Transport = http, width: int = 8, bypass: tuple[str, ...] = BYPASS_HOSTS, strict: tuple[str, ...] = STRICT_DOMAINS, prefer_direct: bool = False) -> DataFrame:
    """(url, html, text, status_code, etag, error, ok, route) of each frontier row (url, prefetched_html).

    Bypassed hosts are asked themselves. All others are asked through the proxy (but with ``prefer_direct``), and what it fails goes to
    the site, where the domain is not strict or the proxy gave a missing page. Rows with ``prefetched_html`` are not asked.
    ``route``: held, direct, proxy or fallback. ``keep(df, name)`` writes a relation and reads it again, so that no call is made
    twice because two later steps read it. A null url is asked like any other and fails.
    """
    rows = frontier.select("url", "prefetched_html", F.coalesce(urls.host(F.col("url")).isin(*bypass), F.lit(False)).alias("__bypass"), F.coalesce(urls.root_domain(F.col("url")).isin(*strict), F.lit(False)).alias("__strict"))
    held = rows.where(F.col("prefetched_html").isNotNull()).select("url", F.col("prefetched_html").alias("html"), F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("error"), F.lit("held").alias("route"))
    rows = rows.where(F.col("prefetched_html").isNull())
    itself = F.col("__bypass") | F.lit(prefer_direct)
    asked = keep(by_proxy(rows.where(~itself), proxy, transport, width), "proxied")
    asked = asked.withColumn("__strict", F.coalesce(urls.root_domain(F.col("url")).isin(*strict), F.lit(False)))
    onward = F.col("error").isNotNull() & (~F.col("__strict") | (F.col("error") == SOFT_404))
    first = rows.where(itself).select("url", F.lit("direct").alias("route"))
    second = asked.where(onward).select("url", F.lit("fallback").alias("route"))
    answers = [keep(direct(part, how, transport, width), name).withColumn("route", F.lit(name)) for part, name in ((first, "direct"), (second, "fallback"))]
    out = asked.where(~onward).drop("__strict").withColumn("route", F.lit("proxy"))
    for part in (held, *answers):
        out = out.unionByName(part)
    text = F.when(F.col("route") == "proxy", F.col("html")).otherwise(plain_text(F.col("html")))
    return out.withColumn("text", text).withColumn("ok", F.col("html").isNotNull() & F.col("error").isNull())


def fetch(frontier: DataFrame, how: Direct, transport: Transport = http, width: int = 8) -> DataFrame:
    """(url, html, text, status_code, etag, error, ok) from the sites themselves; rows with ``prefetched_html`` are not asked."""
    held = frontier.where(F.col("prefetched_html").isNotNull()).select("url", F.col("prefetched_html").alias("html"), F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("error"))
    out = held.unionByName(direct(frontier.where(F.col("prefetched_html").isNull()), how, transport, width))
    return out.withColumn("text", plain_text(F.col("html"))).withColumn("ok", F.col("html").isNotNull() & F.col("error").isNull())
