"""Queries over the fixture tables, one or more for each operator, with the SQL that gives the same rows.

Page text of products does not occur in the fixtures. Extractors are run on text put together from columns, and
the SQL selects those columns: what goes in must come out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text, urls
from tessera.operators import cascade, changes, enrich, extract, frontier, migrate, names, normalise, pages, reports, resolve, store
from tessera.plans import daily
from tessera.plans.resumable import ResumableRun
from tessera.session import shared_folder, spread
from tessera.sources import fetching
from tessera.streaming import ledger

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
RUN_TS = "2024-02-01T00:00:00Z"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


_SLUG = "coalesce(nullif(trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown')"
_CLEAN_URL = "regexp_replace(regexp_replace(url, '\\?(utm_source=feed|page=2&ref=x)', CASE WHEN url LIKE '%page=2%' THEN '?page=2' ELSE '' END), '^$', '')"
_TEXT = r"""array_to_string(list_filter(list_transform(string_split(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<svg\b.*?</svg\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]*>', chr(10), 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10))"""


# ── text and URLs ─────────────────────────────────────────────────────────────────────────────────


@query(f"select p_partkey, {_SLUG.format('p_name')} as slug, replace({_SLUG.format('p_name')}, '-', '_') as token from part")
def slugify_names(spark, sf):
    return t(spark, sf, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.slug(F.col("p_name"), "_", None).alias("token"))


@query(f"select page_id, {_CLEAN_URL} as clean_url from pages")
def clean_urls(spark, sf):
    return t(spark, sf, "pages").select("page_id", urls.without_tracking(F.col("url")).alias("clean_url"))


@query("select array_to_string(list_slice(string_split(regexp_extract(url, '://([^/:?#]+)', 1), '.'), -2, -1), '.') as root_domain, count(*) as n from pages group by 1")
def root_domain_counts(spark, sf):
    return t(spark, sf, "pages").groupBy(urls.root_domain(F.col("url")).alias("root_domain")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """with p as (select page_id, regexp_extract(url, '://[^/?#]+([^?#]*)', 1) as path from pages),
    s as (select page_id, list_filter(string_split(lower(path), '/'), lambda x: x <> '') as seg from p)
    select page_id, not (len(list_intersect(seg, ['faq', 'login', 'apply', 'media', 'offers', 'app', 'help', 'support', 'press'])) > 0) as fetch, false as discovery_fetch from s"""
)
def url_filter(spark, sf):
    url = F.col("url")
    return t(spark, sf, "pages").select("page_id", urls.may_fetch(url, F.lit(False)).alias("fetch"), urls.may_fetch(url, F.lit(True)).alias("discovery_fetch"))


@query(f"select page_id, cast(length({_TEXT}) as bigint) as n_chars, sha256({_TEXT}) as sha from pages")
def html_to_text(spark, sf):
    rows = pages.to_pages(t(spark, sf, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", long(F.length("markdown")).alias("n_chars"), "sha")


@query(
    """select page_id, cast(generate_subscripts(h, 1) - 1 as bigint) as pos, site || unnest(h) as link
    from (select page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') as site, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages)"""
)
def resolve_links(spark, sf):
    """Every anchor in page order as a full URL."""
    rows = t(spark, sf, "pages").select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    return rows.select("page_id", long("pos").alias("pos"), urls.resolve(F.col("url"), F.col("href")).alias("link"))


@query(
    """with l as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href, regexp_extract(url, '^[a-z]+://[^/?#]+') as site,
    generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) as i from pages),
    f as (select page_id, site || href as link, min(i) as i from l group by 1, 2)
    select page_id, cast(row_number() over (partition by page_id order by i) - 1 as bigint) as pos, link from f"""
)
def harvest_links(spark, sf):
    return frontier.harvest(t(spark, sf, "pages").select("page_id", "url", "html")).select("page_id", long("pos").alias("pos"), "link")


# ── frontier ──────────────────────────────────────────────────────────────────────────────────────


@query(
    f"""with a as (select page_id * 1000 as seq, {_CLEAN_URL} as url from pages),
    l as (select page_id * 1000 + generate_subscripts(h, 1) as seq, site || unnest(h) as url from (select page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') as site, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages))
    select url, cast(min(seq) as bigint) as seq from (select * from a union all select * from l) group by 1"""
)
def frontier_first_wins(spark, sf):
    rows = t(spark, sf, "pages")
    own = rows.select(long(F.col("page_id") * 1000).alias("seq"), urls.without_tracking(F.col("url")).alias("url"))
    found = rows.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    found = found.select(long(F.col("page_id") * 1000 + F.col("pos") + 1).alias("seq"), urls.resolve(F.col("url"), F.col("href")).alias("url"))
    return frontier.first_wins(frontier.gather(own, found), ["url"]).select("url", "seq")


@query(
    """with o as (select o_custkey as url, o_orderkey as seq, o_orderstatus = 'F' as l from orders)
    select url, cast(coalesce(max(case when l then seq end), min(seq)) as bigint) as seq, bool_or(l) as is_listing, cast(min(seq) as bigint) as pos from o group by 1"""
)
def listing_wins(spark, sf):
    rows = t(spark, sf, "orders").select(F.col("o_custkey").alias("url"), F.col("o_orderkey").alias("seq"), (F.col("o_orderstatus") == "F").alias("is_listing"))
    return frontier.listing_wins(rows)


@query(
    """with p as (select p_brand as issuer_id, p_partkey as seq, row_number() over (partition by p_brand order by p_partkey) as r from part),
    a as (select 'Brand#' || i as issuer_id, i as n from range(1, 26) x(i))
    select p.issuer_id, seq from p left join a using (issuer_id) where r <= 20 - coalesce(n, 0)"""
)
def per_issuer_cap(spark, sf):
    rows = t(spark, sf, "part").select(F.col("p_brand").alias("issuer_id"), F.col("p_partkey").alias("seq"))
    added = spark.range(1, 26).select(F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("issuer_id"), F.col("id").alias("n"))
    return frontier.cap_harvest(rows, added, 20)


@query(
    """select issuer_id, url, cast(min(seq) as bigint) as seq from (select s_nationkey as issuer_id, s_suppkey % 40 as url, s_suppkey as seq from supplier
    union all select c_nationkey, c_custkey % 40, 1000000000 + c_custkey from customer) group by 1, 2"""
)
def source_precedence(spark, sf):
    """Within an issuer the first source that has a URL counts."""
    a = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("issuer_id"), (F.col("s_suppkey") % 40).alias("url"), F.col("s_suppkey").alias("seq"))
    b = t(spark, sf, "customer").select(F.col("c_nationkey").alias("issuer_id"), (F.col("c_custkey") % 40).alias("url"), (F.col("c_custkey") + 1000000000).alias("seq"))
    rows = frontier.gather(a, b).withColumn("is_listing", F.lit(False))
    return frontier.by_precedence(rows).select("issuer_id", "url", "seq")


@query("select doc_id, contains(lower(text), 'thing') or contains(lower(text), 'keit') or contains(lower(text), 'mentre') as relevant from documents")
def keyword_relevance(spark, sf):
    return t(spark, sf, "documents").select("doc_id", frontier.relevant(F.col("text"), ("thing", "keit", "MENTRE")).alias("relevant"))


@query(
    """with e as (select event_id as seq, event_id % 7 as n from events),
    s as (select seq, coalesce(sum(n) over (order by seq rows between unbounded preceding and 1 preceding), 0) as before from e)
    select seq from s where before < 5000"""
)
def early_stop(spark, sf):
    rows = t(spark, sf, "events").select(F.col("event_id").alias("seq"), (F.col("event_id") % 7).alias("n"))
    return frontier.stop_after(rows, "n", 5000).select("seq")


# ── pages ─────────────────────────────────────────────────────────────────────────────────────────


@query(
    """select doc_id, length(text) < 200 as near_empty, regexp_matches(lower(split_part(text[:200], chr(10), 1)), 'page not found|404 error|error 404|page doesn''t exist|page does not exist') as soft_404 from documents"""
)
def near_empty_and_soft_404(spark, sf):
    return t(spark, sf, "documents").select("doc_id", pages.near_empty(F.col("text")).alias("near_empty"), pages.soft_404(F.col("text")).alias("soft_404"))


@query(
    """select a.doc_id from documents a where doc_id % 2 = 0 and not exists (select 1 from documents b where b.doc_id % 2 = 1 and b.lang = a.lang and sha256(b.text) = sha256(a.text))"""
)
def unchanged_skip(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.col("lang").alias("url"), F.sha2("text", 256).alias("sha"))
    seen = d.where("doc_id % 2 = 1").select("url", F.col("sha").alias("raw_text_sha256"))
    return pages.unchanged(d.where("doc_id % 2 = 0"), seen).select("doc_id")


@query("select sha256(text) as sha, count(*) as n from documents group by 1 having count(*) > 1")
def content_copies(spark, sf):
    return pages.content_copies(t(spark, sf, "documents"))


@query(
    """with p as (select page_id, case page_id % 5 when 0 then 404 when 1 then 500 else 200 end as status, page_id % 7 = 0 as failed, url,
    case when page_id % 3 = 0 then regexp_extract(url, '^[a-z]+://[^/?#]+') || '/gone' when page_id % 3 = 1 then url || '#x' else url end as final,
    lower(html) as body from pages),
    c as (select *, case when contains(body, 'page not found') then 'page not found' when status <> 200 and contains(body, '404') then '404' end as phrase,
    regexp_extract(url, '://[^/?#]+([^?#]*)', 1) <> regexp_extract(final, '://[^/?#]+([^?#]*)', 1) as moved from p)
    select page_id, case when failed or status >= 400 or phrase is not null then 'BROKEN' when moved then 'REDIRECTED' else 'OK' end as category from c"""
)
def url_health(spark, sf):
    url = F.col("url")
    final = F.when(F.col("page_id") % 3 == 0, F.concat(F.regexp_extract(url, "^[a-z]+://[^/?#]+", 0), F.lit("/gone"))).when(F.col("page_id") % 3 == 1, F.concat(F.substring_index(url, "#", 1), F.lit("#x"))).otherwise(url)
    status = F.when(F.col("page_id") % 5 == 0, 404).when(F.col("page_id") % 5 == 1, 500).otherwise(200)
    error = F.when(F.col("page_id") % 7 == 0, F.lit("TIMEOUT"))
    rows = t(spark, sf, "pages")
    return rows.select("page_id", pages.health(error, status, pages.error_phrase(F.col("html"), status), urls.moved(url, final)).alias("category"))


@query(
    r"""with c as (select regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as issuer_id, case when page_id % 7 = 0 or page_id % 5 < 2 then 'BROKEN' when page_id % 3 = 0 then 'REDIRECTED' else 'OK' end as category,
    case when page_id % 7 = 0 then 'TIMEOUT' when page_id % 5 = 0 then 'HTTP 404' when page_id % 5 = 1 then 'HTTP 500' end as reason from pages)
    select case grouping(category, reason) when 0 then 'reason' when 1 then 'category' else 'all' end as level, category, reason, count(*) as urls, count(distinct issuer_id) as issuers
    from c group by grouping sets ((category, reason), (category), ())"""
)
def health_report(spark, sf):
    """Classes, reasons and totals of checked pages."""
    i, none = F.col("page_id"), F.lit(None).cast("string")
    status = F.when(i % 5 == 0, 404).when(i % 5 == 1, 500).otherwise(200)
    rows = t(spark, sf, "pages").select(urls.host(F.col("url")).alias("issuer_id"), "url", F.when(i % 7 == 0, "TIMEOUT").alias("error"), status.alias("status"), none.alias("phrase"), (i % 3 == 0).alias("moved"))
    return reports.health_report(rows.withColumn("category", pages.health(F.col("error"), F.col("status"), F.col("phrase"), F.col("moved"))))


@query(
    """select page_id, sha256(concat('main', case when page_id % 2 = 0 then '' else concat(chr(10), chr(10), '## FEES CHARGES', chr(10), repeat('f' || page_id, 200), chr(10), chr(10), '## BENEFITS', chr(10), repeat('b' || page_id, 200)) end)) as sha from pages"""
)
def supplements(spark, sf):
    p = t(spark, sf, "pages").select("page_id", F.concat(F.lit("http://x/"), F.col("page_id")).alias("url"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("issuer_id"), F.lit("main").alias("markdown"))
    suffixes = spark.createDataFrame([("odd", "/fees-charges", 0), ("odd", "/benefits", 1)], "issuer_id string, suffix string, pos int")
    texts = p.select(F.concat("url", F.lit("/fees-charges")).alias("url"), F.repeat(F.concat(F.lit("f"), F.col("page_id")), F.lit(200)).alias("text"))
    texts = texts.union(p.select(F.concat("url", F.lit("/benefits")), F.repeat(F.concat(F.lit("b"), F.col("page_id")), F.lit(200))))
    return pages.with_supplements(p, suffixes, texts).select("page_id", F.sha2("markdown", 256).alias("sha"))


# ── resolving ─────────────────────────────────────────────────────────────────────────────────────


@query(
    """with e as (select user_id as card_id, event_id as seq, case when event_id % 3 > 0 then event_type end as a, case when event_id % 5 > 0 then value end as b, case when event_id % 2 > 0 then props end as c from events),
    r as (select *, row_number() over (partition by card_id order by (a is not null)::int + (b is not null)::int + (c is not null)::int desc, seq) as k, min(seq) over (partition by card_id) as pos from e)
    select card_id, seq, a, b, c, pos from r where k = 1"""
)
def fullest_record(spark, sf):
    e, seq = t(spark, sf, "events"), F.col("event_id")
    rows = e.select(F.col("user_id").alias("card_id"), seq.alias("seq"), F.when(seq % 3 > 0, F.col("event_type")).alias("a"), F.when(seq % 5 > 0, F.col("value")).alias("b"), F.when(seq % 2 > 0, F.col("props")).alias("c"))
    return resolve.fullest(rows)


@query("select p_brand, array_to_string(list_sort(list_distinct(string_split(lower(p_name), ' '))), ' ') as key, count(*) as n from part group by 1, 2")
def near_duplicate_blocks(spark, sf):
    return t(spark, sf, "part").groupBy("p_brand", resolve.name_key(F.col("p_name")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey, min(p_partkey) over (partition by p_brand, lower(p_name)) as kept_by from part")
def near_duplicate_collapse(spark, sf):
    """Spellings of one name within a brand: "blue bolt", "Blue Bolt Card", "the blue bolt card"."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" card"))).otherwise(F.concat(F.lit("the "), F.col("p_name"), F.lit(" card")))
    rows = t(spark, sf, "part").select(F.col("p_brand").alias("issuer_id"), name.alias("card_name"), F.col("p_partkey").alias("seq"))
    return resolve.collapse_names(rows).select(F.col("seq").alias("p_partkey"), "kept_by")


@query(
    """with a as (select p_partkey as id, p_brand, p_name from part where p_partkey % 2 = 0), b as (select p_partkey as other_id, p_brand, p_name from part where p_partkey % 2 = 1),
    j as (select id, other_id, len(list_intersect(list_filter(list_distinct(string_split(a.p_name, ' ')), lambda x: length(x) > 2), list_filter(list_distinct(string_split(b.p_name, ' ')), lambda x: length(x) > 2))) as score, count(*) over (partition by id) as n from a join b using (p_brand)),
    r as (select *, row_number() over (partition by id order by score desc, other_id) as k from j) select id, other_id, cast(score as bigint) as score from r where k = 1 and (score > 0 or n = 1)"""
)
def best_name_match(spark, sf):
    p = t(spark, sf, "part")
    a = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), "p_brand", F.col("p_name").alias("card_name"))
    b = p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("other_id"), "p_brand", F.col("p_name").alias("card_name"), F.col("p_partkey").alias("seq"))
    return resolve.best_match(a, b, "p_brand").withColumn("score", long("score"))


# ── extraction, there and back ────────────────────────────────────────────────────────────────────


@query(
    """select p_partkey, round(p_retailprice, 2) as joining, cast(p_size * 100 as double) as annual, cast(p_size * 100000 as double) as waiver, cast(p_size % 10 + 1 as double) as fx, p_size % 2 = 0 as gst from part"""
)
def extract_fees(spark, sf):
    size = F.col("p_size")
    md = F.concat(
        F.lit("Joining Fee: Rs. "), F.format_string("%.2f", "p_retailprice"), F.when(size % 2 == 0, " + GST").otherwise(""),
        F.lit("\nAnnual fee (2nd year onwards): ₹"), (size * 100).cast("string"), F.lit("\nFee waived on annual spends of ₹"), size.cast("string"),
        F.lit(" lakh\nForex markup of "), (size % 10 + 1).cast("string"), F.lit("% applies"),
    )
    rows = spread(t(spark, sf, "part"), "p_partkey").select("p_partkey", extract.fees(md).alias("f"))
    return rows.select("p_partkey", F.round("f.joining_fee_inr", 2).alias("joining"), F.col("f.annual_fee_inr").alias("annual"), F.col("f.fee_waiver_spend_inr").alias("waiver"), F.col("f.fx_markup_pct").alias("fx"), F.coalesce("f.gst_extra", F.lit(False)).alias("gst"))


@query(
    """select p_partkey, cast(p_size % 9 + 1 as bigint) * (case p_size % 3 when 0 then 4 when 1 then 2 else 1 end) as domestic, cast(p_size % 5 + 1 as bigint) as international,
    case when p_size % 2 = 0 then 'Priority Pass' else 'DreamFolks' end as program, p_size > 25 as guest from part"""
)
def extract_lounge(spark, sf):
    size = F.col("p_size")
    md = F.concat(
        (size % 9 + 1).cast("string"), F.lit(" complimentary domestic lounge visits "), F.when(size % 3 == 0, "per quarter").when(size % 3 == 1, "per half-year").otherwise("a year"),
        F.lit(".\n" + "-" * 100 + "\n"), (size % 5 + 1).cast("string"), F.lit(" international lounge visits with "), F.when(size % 2 == 0, "Priority Pass").otherwise("DreamFolks"),
        F.when(size > 25, "\nOne guest is free").otherwise(""),
    )
    rows = spread(t(spark, sf, "part"), "p_partkey").select("p_partkey", extract.lounge(md).alias("l"))
    return rows.select("p_partkey", long("l.domestic_visits_year").alias("domestic"), long("l.international_visits_year").alias("international"), F.col("l.program").alias("program"), F.coalesce("l.guest_allowed", F.lit(False)).alias("guest"))


@query(
    """select c_custkey, cast(c_custkey % 90 + 10 as double) * 100000 as air, case when c_custkey * 10 >= 10000 then cast(c_custkey * 10 as double) end as lost,
    cast(18 + c_custkey % 10 as bigint) as min_age, cast(c_custkey % 50 + 5 as double) * 12000 as income, c_custkey % 2 = 0 as salaried from customer"""
)
def extract_insurance_and_eligibility(spark, sf):
    k = F.col("c_custkey")
    md = F.concat(
        F.lit("Air accident cover of ₹"), (k % 90 + 10).cast("string"), F.lit(" lakh.\nLost card liability Rs "), (k * 10).cast("string"), F.lit(".\nMinimum age: "), (18 + k % 10).cast("string"),
        F.lit("\nNet monthly income ₹"), ((k % 50 + 5) * 1000).cast("string"), F.when(k % 2 == 0, "\nFor salaried people").otherwise(""),
    )
    rows = spread(t(spark, sf, "customer"), "c_custkey").select("c_custkey", extract.insurance(md).alias("i"), extract.eligibility(md).alias("e"))
    return rows.select("c_custkey", F.col("i.air_accident_inr").alias("air"), F.col("i.lost_card_inr").alias("lost"), long("e.min_age").alias("min_age"), F.col("e.min_income_inr_year").alias("income"), F.coalesce("e.salaried", F.lit(False)).alias("salaried"))


@query(
    """select p_partkey, case p_size % 4 when 0 then 'Visa' when 1 then 'Mastercard' when 2 then 'RuPay' else 'Amex' end as network, case p_size % 3 when 0 then 'debit' when 1 then 'credit' else 'forex' end as category,
    case p_size % 5 when 0 then 'super-premium' when 1 then 'premium' when 2 then 'student' when 3 then 'entry' end as segment from part"""
)
def extract_identity(spark, sf):
    size = F.col("p_size")
    pick = lambda n, *words: F.element_at(F.array(*[F.lit(w) for w in words]), (size % n + 1).cast("int"))
    md = F.concat(pick(5, "super premium", "premium", "student", "entry level", "plain"), F.lit(" "), pick(3, "debit card", "credit card", "forex card"), F.lit(" on "), pick(4, "VISA", "Mastercard", "rupay", "American Express"), F.lit(" " * 60))
    return spread(t(spark, sf, "part"), "p_partkey").select("p_partkey", extract.network(md).alias("network"), extract.category(md, F.lit("https://x/cards")).alias("category"), extract.segment(md).alias("segment"))


@query(
    """with m as (select o_orderkey, o_orderkey % 8 as k, format('{:,}', o_orderkey % 90 * 100 + 100) as a, format('{:,}', o_orderkey % 70 * 1000 + 1000) as b, cast(o_orderkey % 9 + 1 as varchar) as n from orders),
    p as (select o_orderkey, case k when 0 then 'Joining fee of Rs. ' || a || ' is waived if you spend Rs. ' || b || ' in 90 days.' when 1 then 'Annual fee ₹' || a || ', reversed on spends of ₹' || b
        when 2 then 'On annual spends of ₹' || n || ' lakh, annual fee of ₹' || a || ' is waived' when 3 then 'Joining fee ₹' || a || ' and annual fee ₹' || b when 4 then 'Joining fee nil, renewal fee ₹' || a
        when 5 then 'Annual fee waived on spending ' || n || ' crore' when 6 then 'No joining fee' else 'Earn 4X points. Annual spends get ₹' || a || ' cashback' end as said from m),
    f as (select o_orderkey, said, regexp_extract(said, '(?i)joining fee (?:of )?(?:Rs. |₹)([0-9,]+)', 1) as j, regexp_extract(said, '(?i)annual fee (?:of )?₹([0-9,]+)', 1) as y, regexp_extract(said, '(?i)renewal fee ₹([0-9,]+)', 1) as r,
        case when regexp_matches(said, 'waived|reversed') then regexp_extract(said, 'spend(?:s of|ing)? (?:Rs. |₹)?([0-9,]+)', 1) else '' end as w, regexp_extract(said, '[0-9] (lakh|crore)', 1) as unit from p)
    select o_orderkey, coalesce(try_cast(replace(j, ',', '') as double), case when regexp_matches(said, '(?i)no joining fee|joining fee nil') then 0 end) as joining, try_cast(replace(y, ',', '') as double) as annual,
    try_cast(replace(r, ',', '') as double) as renewal, try_cast(replace(w, ',', '') as double) * case unit when 'lakh' then 100000 when 'crore' then 10000000 else 1 end as waiver_spend from f"""
)
def extract_stated_fees(spark, sf):
    """Fees beside waivers, spends and other amounts in eight ways of saying it; the SQL reads the same texts with patterns of its own."""
    key, as_text = F.col("o_orderkey"), lambda c: F.format_number(c, 0)
    a, b, n = as_text(key % 90 * 100 + 100), as_text(key % 70 * 1000 + 1000), (key % 9 + 1).cast("string")
    ways = (
        ("Joining fee of Rs. ", a, " is waived if you spend Rs. ", b, " in 90 days."), ("Annual fee ₹", a, ", reversed on spends of ₹", b), ("On annual spends of ₹", n, " lakh, annual fee of ₹", a, " is waived"),
        ("Joining fee ₹", a, " and annual fee ₹", b), ("Joining fee nil, renewal fee ₹", a), ("Annual fee waived on spending ", n, " crore"), ("No joining fee",), ("Earn 4X points. Annual spends get ₹", a, " cashback"),
    )
    texts = [F.concat(*[F.lit(x) if isinstance(x, str) else x for x in way]) for way in ways]
    md = F.element_at(F.array(*texts), (key % 8 + 1).cast("int"))
    rows = spread(t(spark, sf, "orders"), "o_orderkey").select("o_orderkey", extract.fees(md).alias("f"))
    names_of = {"joining": "joining_fee_inr", "annual": "annual_fee_inr", "renewal": "renewal_fee_inr", "waiver_spend": "fee_waiver_spend_inr"}
    return rows.select("o_orderkey", *[F.col("f")[field].alias(name) for name, field in names_of.items()])


@query(
    """select p_partkey, round(0.25 * p_size / 150 * 100, 4) as base_rate, cast(p_size % 7 + 2 as double) as swiggy_rate, 'Reward Points' as currency, cast(p_size % 30 + 6 as bigint) as expiry from part"""
)
def extract_rewards(spark, sf):
    size = F.col("p_size")
    md = F.concat(F.lit("Earn "), size.cast("string"), F.lit(" reward points per ₹150 on all spends.\n"), (size % 7 + 2).cast("string"), F.lit("% cashback on Swiggy.\nPoints valid for "), (size % 30 + 6).cast("string"), F.lit(" months from accrual"))
    rows = spread(t(spark, sf, "part"), "p_partkey").select("p_partkey", extract.rewards(md, F.lit("hdfc")).alias("r"))
    return rows.select("p_partkey", F.col("r.base_rate_pct").alias("base_rate"), F.col("r.accelerated")[0]["rate_pct"].alias("swiggy_rate"), F.col("r.currency").alias("currency"), long("r.expiry_months").alias("expiry"))


@query(
    """select o_orderkey, cast(o_orderkey % 9 + 1 as double) * 100000 as spend, case o_orderkey % 3 when 0 then 'monthly' when 1 then 'quarterly' else 'annual' end as period, cast(2 as bigint) as n_highlights, cast(1 as bigint) as n_milestones from orders"""
)
def extract_milestones_and_highlights(spark, sf):
    k = F.col("o_orderkey")
    per = F.when(k % 3 == 0, "month").when(k % 3 == 1, "quarter").otherwise("year")
    line = F.concat(F.lit("Spend ₹"), (k % 9 + 1).cast("string"), F.lit(" lakh in a "), per, F.lit(" and get a gift voucher of worth"))
    md = F.concat(line, F.lit(".\n"), line, F.lit(".\n- 5% cashback on fuel\n* 5% Cashback on fuel\n1. Free golf games\n- nothing here"))
    rows = spread(t(spark, sf, "orders"), "o_orderkey").select("o_orderkey", extract.milestones(md).alias("m"), extract.highlights(md).alias("h"))
    return rows.select("o_orderkey", F.col("m")[0]["spend_inr"].alias("spend"), F.col("m")[0]["period"].alias("period"), long(F.size("h")).alias("n_highlights"), long(F.size("m")).alias("n_milestones"))


@query(
    """select p_partkey, case when p_size % 2 = 0 then 'golf' else 'spa' end as perk, case when p_size % 3 = 0 then 'Swiggy' end as partner, 'https://x.y/apply/' || p_partkey as apply_url from part"""
)
def extract_perks_and_offers(spark, sf):
    size = F.col("p_size")
    md = F.concat(F.when(size % 2 == 0, "Play golf").otherwise("A day at the spa"), F.lit(" every year\n[Apply now](https://x.y/apply/"), F.col("p_partkey"), F.lit(")\n"), F.when(size % 3 == 0, "Order on Swiggy at a 20% discount").otherwise(""))
    rows = spread(t(spark, sf, "part"), "p_partkey").select("p_partkey", extract.perks(md).alias("p"), extract.partner_offers(md).alias("o"), extract.apply_url(md).alias("apply_url"))
    return rows.select("p_partkey", F.col("p")[0]["kind"].alias("perk"), F.col("o")[0]["partner"].alias("partner"), "apply_url")


@query("select n_nationkey, cast(i as bigint) as pos, n_name || ' ' || i || ' Credit Card' as section_name from nation, range(1, 4) r(i)")
def split_sections(spark, sf):
    head = lambda i: F.concat(F.lit("## ["), F.col("n_name"), F.lit(f" {i} Credit Card](http://x/{i})\nSome text\n### Details\nMore\n"))
    rows = t(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("Intro\n"), head(1), head(2), head(3)).alias("markdown"))
    return extract.sections(rows).select("n_nationkey", long("pos").alias("pos"), "section_name")


@query(
    """select p_partkey, upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2) || ' RuPay Credit Card' as name from part"""
)
def name_from_url(spark, sf):
    url = F.concat(F.lit("https://bank.example/cards/some-card-apply-for-"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-rupay-credit-card-online/"))
    return t(spark, sf, "part").select("p_partkey", names.url_name(url).alias("name"))


@query("select p_partkey, p_name || ' Credit Card' as name from part")
def clean_names(spark, sf):
    """Five dressings of a title, all of which come off."""
    n = F.concat("p_name", F.lit(" Credit Card"))
    raw = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("**["), n, F.lit("](http://x/y)**"))).when(F.col("p_partkey") % 5 == 1, F.concat(n, F.lit(" | Some Bank")))
        .when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("Fees and Charges of "), n)).when(F.col("p_partkey") % 5 == 3, F.concat(n, F.lit(" Online"))).otherwise(F.concat(n, F.lit(" with exclusive benefits")))
    )
    return t(spark, sf, "part").select("p_partkey", names.clean(raw).alias("name"))


@query(
    """select p_partkey, case p_partkey % 6 when 0 then null when 1 then 'start' when 2 then 'inside' when 3 then 'no_card' when 4 then 'no_product' else 'generic_kind' end as reason from part"""
)
def valid_names(spark, sf):
    k, n = F.col("p_partkey") % 6, F.col("p_name")
    raw = (
        F.when(k == 0, F.concat(n, F.lit(" Credit Card"))).when(k == 1, F.concat(F.lit("How to use "), n, F.lit(" card"))).when(k == 2, F.concat(n, F.lit(" card: apply now")))
        .when(k == 3, n).when(k == 4, "Add-on Credit Card").otherwise("Fuel Credit Card")
    )
    return t(spark, sf, "part").select("p_partkey", names.reject_reason(raw).alias("reason"))


@query("select p_partkey, p_size % 2 = 0 as grounded from part")
def grounded_names(spark, sf):
    page = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("All about the "), F.upper("p_name"))).otherwise("Another thing entirely")
    return t(spark, sf, "part").select("p_partkey", names.grounded(F.concat("p_name", F.lit(" zzz card")), page).alias("grounded"))


def _made_cards(spark, sf):
    """Product pages made of parts, through the whole extractor."""
    p, size = spread(t(spark, sf, "part"), "p_partkey"), F.col("p_size")
    md = F.concat(
        F.lit("# "), F.initcap("p_name"), F.lit(" Credit Card\nA Visa credit card.\nAnnual fee: ₹"), (size * 100).cast("string"), F.lit(".\nEarn "), size.cast("string"),
        F.lit(" reward points per ₹100 on all spends\n4 domestic lounge visits per quarter with Priority Pass\nPlay golf\nSpend ₹3 lakh in a year and get a voucher of ₹2000"),
    )
    none = F.lit(None).cast("string")
    rows = p.select(
        F.concat(F.lit("https://x.example/cards/"), F.col("p_partkey")).alias("source_url"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_")).alias("issuer_id"), F.col("p_brand").alias("issuer_name"), F.lit(False).alias("is_listing"),
        md.alias("markdown"), none.alias("force_card_name"), none.alias("force_category"), none.alias("force_network"), F.sha2(md, 256).alias("sha"),
    )
    return extract.with_ids(extract.cards(rows), RUN_TS)


@query(
    f"""select 'https://x.example/cards/' || p_partkey as source_url, replace(lower(p_brand), '#', '_') || '__' || {_SLUG.format("p_name")} || '-credit-card' as card_id, 'visa' as network, cast(p_size * 100 as double) as annual_inr,
    round(0.25 * p_size / 100 * 100, 4) as base_rate_pct, 'reward_points' as currency, cast(16 as bigint) as domestic_year, 'priority_pass' as program, cast(300000 as double) as spend_inr, 'annual' as period, 'golf' as perk, cast(0 as bigint) as n_errors from part"""
)
def migrate_and_validate(spark, sf):
    v2 = migrate.validated(migrate.to_v2(_made_cards(spark, sf)))
    return v2.select(
        "source_url", "card_id", "network", F.col("fees.annual_inr").alias("annual_inr"), F.col("rewards.base_rate_pct").alias("base_rate_pct"), F.col("rewards.currency").alias("currency"),
        long("lounge_access.domestic_year").alias("domestic_year"), F.col("lounge_access.program").alias("program"), F.col("milestones")[0]["spend_inr"].alias("spend_inr"), F.col("milestones")[0]["period"].alias("period"),
        F.col("perks")[0]["kind"].alias("perk"), long(F.size("errors")).alias("n_errors"),
    )


@query(
    """select 'p' || p_partkey as card_id, case when p_size % 2 = 0 then 'cashback' when p_size % 3 = 0 then null else 'miles' end as currency, case when p_size % 5 > 0 then cast(p_size as double) end as base_units,
    case when p_size % 3 > 0 then 'dining,fuel' end as categories, case when p_size % 3 > 0 then p_size / 10 end as dining_pct, case when p_size % 3 > 0 and p_size % 4 = 0 then 'monthly' end as dining_period,
    case when p_size > 10 then cast(p_size * 1000 as double) else 7 end as spend_inr, case when p_size % 7 = 0 then cast(p_size as double) end as welcome_units,
    'brand' || p_size as partner, p_size % 11 > 0 as normalised from part where p_size % 11 > 0
    union all select 'p' || p_partkey, case when p_size % 2 = 0 then 'cashback' end, null, null, null, null, 7, null, null, false from part where p_size % 11 = 0"""
)
def normalised_answers(spark, sf):
    """Answers with numbers in quotes, unknown and misplaced names and empty entries, merged by policy."""
    size, p = F.col("p_size"), spread(t(spark, sf, "part"), "p_partkey")
    cards = p.select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("card_id"), F.lit("i").alias("issuer_id"), F.col("p_name").alias("card_name"),
        F.struct(F.when(size % 2 == 0, "cashback").alias("currency")).alias("rewards"), F.array(F.struct(F.lit(7.0).alias("spend_inr"))).alias("milestones"), F.array(F.col("p_name")).alias("highlights"), size,
    )
    said = F.format_string(
        '{"currency": %s, "base": {"units": %s, "rate_pct": "5"}, "rewards": {"currency": "moon"}, "category_rewards": {%s: {"rate_pct": %s, "cap_period": "%s", "note": 1}, "Fuel!": {"units": 1}, "moon": {"units": 1}, "upi": {"cap_inr": 5}},'
        ' "milestones": [{"spend_inr": %s}, {"spend_inr": "9"}, 3], "welcome": {"reward_units": %s, "within_days": 3}, "partner_offers": [{"partner": "Brand %s"}, {"value_pct": 2}]}',
        F.when(size % 3 == 0, "null").otherwise('"miles"'), F.when(size % 5 == 0, '"2"').otherwise(size.cast("string")), F.when(size % 3 == 0, '"fuels"').otherwise('" Dining"'), (size / 10).cast("string"),
        F.when(size % 4 == 0, "monthly").otherwise("weekly"), F.when(size > 10, (size * 1000).cast("string")).otherwise("0"), F.when(size % 7 == 0, size.cast("string")).otherwise("null"), size.cast("string"),
    )
    # a third of the answers call a category by a name that counts for nothing, fuel included
    said = F.when(size % 3 == 0, F.replace(said, F.lit('"Fuel!"'), F.lit('"fuel cards"'))).otherwise(said)
    answers = cards.select("card_id", F.when(size % 11 > 0, said).alias("answer"))
    rows = normalise.apply_answers(cards, answers)
    category = F.col("rewards.category_rewards")
    return rows.select(
        "card_id", F.col("rewards.currency").alias("currency"), F.col("rewards.base_units").alias("base_units"), F.array_join(F.map_keys(category), ",").alias("categories"), category["dining"]["rate_pct"].alias("dining_pct"),
        category["dining"]["cap_period"].alias("dining_period"), F.col("milestones")[0]["spend_inr"].alias("spend_inr"), F.col("welcome_benefit.reward_units").alias("welcome_units"), F.col("partner_offers")[0]["partner"].alias("partner"), "normalised",
    )


@query(
    """select 'u' || p_partkey as source_url, case when p_size % 3 = 0 then 'ok' when p_size % 5 = 0 then 'empty' when p_size % 4 = 3 then 'retry' when p_size % 2 = 0 then 'ok' else 'empty' end as status,
    case when p_size % 3 = 0 then 'rules' when p_size % 5 = 0 then 'listing' else 'provider' end as step, cast(case when p_size % 3 = 0 or p_size % 5 = 0 then 1 else least(p_size % 4 + 1, 3) end as bigint) as n_runs,
    case when p_size % 3 = 0 then 'Gold Star Card' when p_size % 5 > 0 and p_size % 4 < 3 and p_size % 2 = 0 then 'Silver Comet Card' end as card_name from part"""
)
def cascade_three_runs(spark, sf):
    """Pages through three runs whose provider is down for some of them; each run takes only what is not settled."""
    size, none, root = F.col("p_size"), F.lit(None).cast("string"), shared_folder(spark, "cascade")
    md = F.concat(F.when(size % 3 == 0, "# Gold Star Card").otherwise("Silver Comet Card"), F.lit("\nsize "), size, F.lit("\n"), F.repeat(F.lit("words of the page "), 12))
    pages_ = t(spark, sf, "part").select(
        F.concat(F.lit("u"), F.col("p_partkey")).alias("source_url"), F.col("p_brand").alias("issuer_id"), F.col("p_brand").alias("issuer_name"), (size % 5 == 0).alias("is_listing"), md.alias("markdown"),
        none.alias("force_card_name"), none.alias("force_category"), none.alias("force_network"), F.sha2(md, 256).alias("sha"),
    )

    def rules(rows):
        found = rows.where(F.col("markdown").startswith("# "))
        return found.select("source_url", F.lit(0).alias("pos"), "sha", "issuer_id", F.substring_index(F.substring("markdown", 3, 99), "\n", 1).alias("card_name"))

    def provider(run):
        def ask(prompts):
            sizes = [int(p.split("size ", 1)[1].split("\n", 1)[0]) for p in prompts]
            return [None if n % 4 > run else '{"cards": [{"card_name": "Silver Comet Card"}]}' if n % 2 == 0 else '{"cards": []}' for n in sizes]

        return ask

    tried, cards = spark.createDataFrame([], cascade.ATTEMPTS), None
    for run in range(3):
        def keep(df, name, run=run):
            df.write.parquet(f"{root}/{run}/{name}")
            return spark.read.parquet(f"{root}/{run}/{name}")

        due = keep(cascade.due(pages_, tried), "due")  # once: every step of the run reads it
        got = cascade.extract_pages(due, f"t{run}", keep, rules=rules, provider=provider(run))
        tried = tried.unionByName(got.attempts)
        cards = got.cards if cards is None else cards.unionByName(got.cards)
    return cascade.standing(tried).select("source_url", "status", "step", "n_runs").join(cards.select("source_url", "card_name"), "source_url", "left")


@query("select page_id, sha256(html) as sha from pages where page_id % 10 <> 0")
def resumed_run(spark, sf):
    """Pages worked off in parts: two of them, then as after a stop the others; a tenth of the rows fail and are put aside."""
    folder = shared_folder(spark, "resumable")
    ResumableRun(spark, folder, "page_id", 4).gather(t(spark, sf, "pages").select("page_id", "html"))

    def work(rows):
        return rows.select("page_id", F.sha2("html", 256).alias("sha"), F.when(F.col("page_id") % 10 == 0, "failed").alias("error"))

    ResumableRun(spark, folder, "page_id", 4).resume(work, most=2)
    run = ResumableRun(spark, folder, "page_id", 4)
    run.resume(work)
    return run.results()


# ── tables of record ──────────────────────────────────────────────────────────────────────────────


@query(
    """with o as (select o_custkey, o_orderkey, o_totalprice, o_orderkey % 2 as half from orders),
    a as (select o_custkey, min(o_orderkey) as first_seen_at, arg_max(o_totalprice, o_orderkey) as price from o where half = 0 group by 1), b as (select o_custkey, min(o_orderkey) as first_seen_at, arg_max(o_totalprice, o_orderkey) as price from o where half = 1 group by 1)
    select o_custkey as card_id, coalesce(b.price, a.price) as price, coalesce(a.first_seen_at, b.first_seen_at) as first_seen_at from a full join b using (o_custkey)"""
)
def upsert_keep_first_seen(spark, sf):
    def half(n: int) -> DataFrame:
        o = t(spark, sf, "orders").where(F.col("o_orderkey") % 2 == n)
        return o.groupBy(F.col("o_custkey").alias("card_id")).agg(F.max_by("o_totalprice", "o_orderkey").alias("price"), F.min("o_orderkey").alias("first_seen_at"))

    return store.upsert(half(0), half(1))


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def new_records(spark, sf):
    """Customers who appear without an urgent order."""
    return changes.appeared(t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), t(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query(
    """with e as (select user_id, event_id, value, event_type, lag(value) over w as v0, lag(event_type) over w as t0 from events window w as (partition by user_id order by ts, event_id)),
    f as (select event_id as card_id, 'fees.annual_fee_inr' as field, v0 as o, value as n, null as so, null as sn from e where v0 is not null union all select event_id, 'rewards.base_rate_pct', v0, value, null, null from e where v0 is not null
    union all select event_id, 'status', null, null, case t0 when 'error' then 'discontinued' else 'active' end, case event_type when 'error' then 'discontinued' else 'active' end from e where v0 is not null)
    select card_id, field, case when field = 'status' and sn = 'discontinued' or field like 'fees%' and n > o or field like 'rewards%' and n < o then 'devaluation' else 'change' end as change_type, o as old_number, n as new_number from f where o is distinct from n or so is distinct from sn"""
)
def change_feed(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t(spark, sf, "events").select("event_id", "value", "event_type", F.lag("value").over(w).alias("v0"), F.lag("event_type").over(w).alias("t0")).where("v0 is not null")

    def side(value: str, kind: str) -> DataFrame:
        none = F.lit(None).cast("double")
        return e.select(
            F.col("event_id").alias("card_id"), F.lit("u").alias("source_url"),
            F.struct(none.alias("joining_fee_inr"), F.col(value).alias("annual_fee_inr"), none.alias("fee_waiver_spend_inr"), none.alias("fx_markup_pct")).alias("fees"),
            F.struct(F.col(value).alias("base_rate_pct"), none.alias("point_value_inr")).alias("rewards"),
            F.struct(none.alias("domestic_visits_year"), none.alias("international_visits_year")).alias("lounge_access"),
            F.when(F.col(kind) == "error", "discontinued").otherwise("active").alias("status"),
        )

    rows = changes.changes(side("v0", "t0"), side("value", "event_type"), RUN_TS)
    return rows.select("card_id", "field", "change_type", "old_number", "new_number")


@query(
    """select s_suppkey as k, coalesce(nullif(case when s_suppkey % 3 = 0 then 'null' else s_name end, 'null'), 'C' || s_suppkey) as name, case when s_suppkey % 2 = 0 then s_acctbal else s_suppkey end as bal from supplier"""
)
def enrich_fill_empty(spark, sf):
    s, k = t(spark, sf, "supplier"), F.col("s_suppkey")
    base = s.select(k.alias("k"), F.struct(F.when(k % 3 == 0, "null").otherwise(F.col("s_name")).alias("name"), F.when(k % 2 == 0, F.col("s_acctbal")).alias("bal")).alias("fees"))
    extra = s.select(k.alias("k"), F.struct(F.concat(F.lit("C"), k).alias("name"), k.cast("double").alias("bal")).alias("fees"))
    return enrich.fill_records(base, extra, "k").select("k", F.col("fees.name").alias("name"), F.col("fees.bal").alias("bal"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_payload_parse(spark, sf):
    """Payloads in a fence, as a model would answer."""
    answer = F.concat(F.lit('```json\n{"cards": ['), F.col("props"), F.lit("]}\n```"))
    rows = t(spark, sf, "events").select("event_id", answer.alias("answer"))
    return enrich.parsed(rows, "struct<k: bigint>").select("event_id", F.col("card.k").alias("k"))


# ── reports ───────────────────────────────────────────────────────────────────────────────────────


@query(
    """with u as (select s_nationkey, count(*) as total, count(*) filter (where s_suppkey % 3 = 0) as done from supplier group by 1), c as (select c_nationkey, count(*) as cards, count(*) filter (where c_acctbal > 0) as with_fees from customer group by 1)
    select n_nationkey as issuer_id, n_regionkey as pos, total, done, coalesce(cards, 0) as cards, coalesce(with_fees, 0) as with_fees from nation join u on n_nationkey = s_nationkey left join c on n_nationkey = c_nationkey"""
)
def issuer_status(spark, sf):
    issuers = t(spark, sf, "nation").select(F.col("n_nationkey").alias("issuer_id"), F.col("n_regionkey").alias("pos"))
    found = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("issuer_id"), F.col("s_suppkey").alias("url"))
    cards = t(spark, sf, "customer").select(F.col("c_nationkey").alias("issuer_id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("fees"))
    return reports.issuer_status(issuers, found, found.where("url % 3 = 0"), cards)


@query(
    """with d as (select p_brand, p_name, max((p_size % 2 = 0)::int) as s from part group by 1, 2), r as (select *, row_number() over (partition by p_brand order by p_name) as r from d)
    select p_brand, count(*) as urls, cast(sum(s) as bigint) as from_sitemap, string_agg(case when r <= 5 then p_name end, '|' order by p_name) as sample, case when count(*) <= 2 then 'LOW' else 'OK' end as flag from r group by 1"""
)
def coverage_summary(spark, sf):
    found = t(spark, sf, "part").select("p_brand", F.col("p_name").alias("url"), (F.col("p_size") % 2 == 0).alias("is_sitemap"), F.lit(None).cast("string").alias("error"), F.col("p_partkey").alias("seq"))
    rows = reports.coverage_flag(reports.coverage(found, "p_brand"))
    return rows.select("p_brand", "urls", long("from_sitemap").alias("from_sitemap"), F.array_join("sample", "|").alias("sample"), "flag")


@query("select n_nationkey, case when n_nationkey % 4 = 0 then 'no issuer' when n_nationkey % 4 = 1 then 'unknown issuer' when n_nationkey % 4 = 2 then 'issuer id' else null end as reason from nation")
def purge_reasons(spark, sf):
    k = F.col("n_nationkey") % 4
    issuer = F.when(k == 0, " ").when(k == 1, "Unknown").when(k == 2, "Foo Bank").otherwise("foo_bank")
    rows = t(spark, sf, "nation").select("n_nationkey", issuer.alias("issuer_id"), F.concat(F.lit("Foo "), F.col("n_name"), F.lit(" Credit Card")).alias("card_name"))
    return reports.purge_reasons(rows).select("n_nationkey", "reason")


@query(f"select p_brand as issuer_id, count(distinct {_SLUG.format('p_name')}) as n, min({_SLUG.format('p_name')}) as first_url from part group by 1")
def url_lists_by_issuer(spark, sf):
    """Lists written as sorted text files and read back."""
    folder = shared_folder(spark, "url-lists")
    store.write_url_lists(t(spark, sf, "part").select(F.col("p_brand").alias("issuer_id"), text.slug(F.col("p_name")).alias("url")), folder)
    return store.read_url_lists(spark, folder).groupBy("issuer_id").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first_url"))


@query(
    """with l as (select distinct page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') || unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as link from pages)
    select link, not regexp_matches(lower(link), '/(credit-cards?|debit-cards?|cards?|creditcard)/?$|add-on-card|block-lost|loststolen|compare|/faq|membership-kit|netbanking|/support|terms-and-cond|-calculator|/category|/(offers?|services?)$') as listed,
    count(*) as pages from l group by 1"""
)
def links_for_lists(spark, sf):
    """Links of all pages, and whether a curated list would take them."""
    rows = frontier.harvest(t(spark, sf, "pages").select("page_id", "url", "html")).groupBy("link").agg(F.count(F.lit(1)).alias("pages"))
    return rows.select("link", urls.may_list(F.col("link")).alias("listed"), "pages")


# ── discovery and routes ──────────────────────────────────────────────────────────────────────────


_HEX = "(instr('0123456789abcdef', substr(md5(url), {}, 1)) - 1)"


def _made_site(url: str, headers: dict[str, str], timeout: float) -> tuple[int, str, str | None]:
    """A transport without a network: the answer is told by the digest of the page's URL."""
    asked, page = url.startswith("proxy/"), url.removeprefix("proxy/")
    kind = int(hashlib.md5(page.encode()).hexdigest()[0 if asked else 1], 16) % (4 if asked else 3)
    if kind == 3 or (not asked and kind == 2):
        raise OSError("no answer")
    if asked:
        return [(200, f"# {page}", None), (503, "", None), (200, "Page Not Found", None)][kind]
    return [(200, f"<p>{page}</p>", "tag"), (404, "", None)][kind]


@query(
    f"""with u as (select distinct url, regexp_extract(url, '://([^/:?#]+)', 1) as host from pages),
    k as (select url, host in ('blog.tionsh.example.net', 'thther.example.org') as bypass, host like '%.example.org' as strict, {_HEX.format(1)} % 4 as p, {_HEX.format(2)} % 3 as d from u),
    r as (select *, case when bypass then 'direct' when p = 0 or (strict and p <> 2) then 'proxy' else 'fallback' end as route from k)
    select url, route, case when route = 'proxy' then p = 0 else d = 0 end as ok, cast(coalesce(case when route = 'proxy' then case p when 0 then 200 when 1 then 503 end else case d when 0 then 200 when 1 then 404 end end, 0) as bigint) as status_code,
    case when route = 'proxy' and p = 0 then '# ' || url when route <> 'proxy' and d = 0 then url end as text from r"""
)
def routed_fetch(spark, sf):
    """Every page's URL through the router, with a transport that answers by rule."""
    folder = shared_folder(spark, "routes")
    rows = t(spark, sf, "pages").select("url").distinct().withColumn("prefetched_html", F.lit(None).cast("string"))
    got = fetching.routed(
        rows, fetching.Proxy("proxy/", gap_s=0), fetching.Direct(gap_s=0, attempts=1), lambda df, name: _kept(df, f"{folder}/{name}"), _made_site,
        bypass=("blog.tionsh.example.net", "thther.example.org"), strict=("example.org",),
    )
    return got.select("url", "route", "ok", long(F.coalesce("status_code", F.lit(0))).alias("status_code"), F.when(F.col("ok"), F.col("text")).alias("text"))


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HOP = """select regexp_extract(url, '^[a-z]+://[^/?#]+') || unnest(h) as link, generate_subscripts(h, 1) as pos, {} from
    (select *, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from {})"""
_RANKED = """select * from (select *, row_number() over (partition by seed order by {0}, pos) as r from (select seed, {0}, link, min(pos) as pos from {1} group by all)) where r <= 60"""
_WANTED = "regexp_matches(lower(link), 'an|the|qu')"


@query(
    f"""with s as (select url, min(page_id) as seed from pages group by 1), a as (select s.url, s.seed, 0 as ord, p.html from s join pages p on p.page_id = s.seed),
    l1 as ({_HOP.format("seed, ord", "a")}), k1 as ({_RANKED.format("ord", "l1")}),
    c1 as (select link, min_by(seed, seed * 1000 + pos) as seed, min_by(pos, seed * 1000 + pos) as ord from k1 where {_WANTED} group by 1),
    f as (select c1.link as url, seed, ord, html from c1 join pages p on p.page_id = cast('0x' || substr(md5(c1.link), 1, 6) as int) % (select count(*) from pages) where c1.link not in (select url from s)),
    l2 as ({_HOP.format("seed, ord", "f")}), k2 as ({_RANKED.format("ord", "l2")}),
    c2 as (select link, min(seed) as seed from k2 where {_WANTED} and link not in (select link from c1) group by 1)
    select link, s.url as seed, 1::bigint as hop from c1 join s using (seed) union all select link, s.url, 2 from c2 join s using (seed)"""
)
def discovery_scan(spark, sf):
    """Two hops from all pages as seeds; a link that is no page of the table is answered by the page that its digest names."""
    folder, rows = shared_folder(spark, "scan"), t(spark, sf, "pages")
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    own = rows.groupBy("url").agg(F.min("page_id").alias("own"))

    def answers(asked: DataFrame) -> DataFrame:
        named = F.pmod(F.conv(F.substring(F.md5("url"), 1, 6), 16, 10).cast("long"), F.col("total"))
        page = asked.join(own, "url", "left").join(F.broadcast(total)).select("url", F.coalesce("own", named).alias("page_id"))  # total is one row
        return page.join(rows.select("page_id", "html"), "page_id").select("url", "html", F.lit("").alias("text"))

    seeds = rows.select(F.col("page_id").alias("seed_pos"), "url")
    found = frontier.scan(seeds, answers, ("an", "THE", "qu"), lambda df, name: _kept(df, f"{folder}/{name}"), depth=2)
    return found.select("link", "seed", long("hop").alias("hop"))


@query(
    """select 'sup_' || s_suppkey as issuer_id, cast(500 + s_suppkey % 50 * 10 + case when s_nationkey < 5 then 100 else 0 end as double) as annual_fee, 't1' as first_seen,
    case when s_nationkey < 5 then 't2' else 't1' end as last_scraped, case when s_nationkey < 5 then 'devaluation' end as change_type from supplier"""
)
def daily_run(spark, sf):
    """Two daily runs over a page of each supplier; on the second day some pages state a higher fee."""
    rows = t(spark, sf, "supplier").join(F.broadcast(t(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    key = F.col("s_suppkey").cast("string")
    rows = rows.select(
        F.concat(F.lit("https://s"), key, F.lit(".example/cards/gold")).alias("url"), F.concat(F.lit("sup_"), key).alias("issuer_id"), F.concat(F.lit("Issuer "), key).alias("issuer_name"),
        F.lit(False).alias("is_listing"), *[F.lit(None).cast("string").alias(c) for c in ("force_card_name", "force_category", "force_network", "prefetched_html")],
        F.lit(False).alias("is_discovery"), long("s_suppkey").alias("seq"), F.initcap("n_name").alias("name"), "s_nationkey",
    )
    versions = daily.Versions(spark, shared_folder(spark, "daily"))
    for run_ts, rise in (("t1", 0), ("t2", 100)):
        fee = F.lit(500) + F.col("seq") % 50 * 10 + F.when(F.col("s_nationkey") < 5, rise).otherwise(0)
        body = F.concat(F.lit("# "), "name", F.lit(" Gold Credit Card\nA Visa credit card. Annual fee: ₹"), fee.cast("string"), F.lit(".\n" + "More about this product. " * 10))
        served = rows.select("url", body.alias("text"), F.lit(None).cast("string").alias("etag"), F.lit(True).alias("ok"))
        daily.run_daily(versions, rows.drop("name", "s_nationkey"), lambda asked, served=served: asked.join(served, "url").withColumn("html", F.col("text")), run_ts)
    changed = versions.read("changes").select("card_id", "change_type")
    out = versions.read("cards").join(changed, "card_id", "left")
    return out.select("issuer_id", F.col("fees.annual_fee_inr").alias("annual_fee"), F.col("first_seen_at").alias("first_seen"), F.col("last_scraped_at").alias("last_scraped"), "change_type")


# ── streams (an extension) and the flagship ───────────────────────────────────────────────────────


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = t(spark, sf, "events").schema
    return ledger.arriving(spark, sf, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("select cast(date_trunc('day', ts) as varchar) as start, event_type, count(*) as n from events group by 1, 2")
def stream_daily_counts(spark, sf):
    folder = shared_folder(spark, "daily-counts")
    rows = ledger.counts(_stream(spark, sf), "ts", "1 day", "1 day", by=["event_type"])
    ledger.run_totals(rows, f"{folder}/rows", f"{folder}/checkpoint")
    found = spark.read.schema("start timestamp, event_type string, n long").parquet(f"{folder}/rows")
    return found.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("select distinct user_id, event_type from events")
def stream_first_seen(spark, sf):
    folder = shared_folder(spark, "first-seen")
    rows = ledger.first_seen(_stream(spark, sf), ["user_id", "event_type"], "ts").select("user_id", "event_type")
    ledger.run_once(rows, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema("user_id long, event_type string").parquet(f"{folder}/rows")


@query(
    f"""with c as (select {_CLEAN_URL} as url, min(page_id) as page_id from pages group by 1)
    select array_to_string(list_slice(string_split(regexp_extract(p.url, '://([^/:?#]+)', 1), '.'), -2, -1), '.') as root_domain, count(*) as pages,
    count(distinct sha256({_TEXT})) as texts, cast(sum(len(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) as bigint) as links from pages p join c using (page_id) where length({_TEXT}) >= 200 group by 1"""
)
def page_catalogue(spark, sf):
    """Pages without copies of a URL, by domain: scan, clean, dedupe, text, hash, filter, links, aggregate."""
    rows = t(spark, sf, "pages").withColumn("clean", urls.without_tracking(F.col("url"))).withColumnRenamed("page_id", "seq")
    rows = pages.to_pages(frontier.first_wins(rows, ["clean"]))
    rows = rows.where(~pages.near_empty(F.col("markdown")) & ~pages.soft_404(F.col("markdown")))
    rows = rows.select(urls.root_domain(F.col("url")).alias("root_domain"), "sha", long(F.size(urls.links(F.col("html"), F.col("url")))).alias("n"))
    return rows.groupBy("root_domain").agg(F.count(F.lit(1)).alias("pages"), F.countDistinct("sha").alias("texts"), F.sum("n").alias("links"))
