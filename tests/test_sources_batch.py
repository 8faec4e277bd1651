from pyspark.sql import functions as F

from tessera.operators import frontier
from tessera.plans.batch import run_batch
from tessera.sources import catalog, fetching


def test_url_lists(spark, tmp_path):
    (tmp_path / "one.txt").write_text("# c\nhttp://a/1\n\n http://a/2 \n")
    got = catalog.url_lists(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.issuer_id, r.url) for r in got] == [("one", "http://a/1"), ("one", "http://a/2")]


def test_issuers_keep_ids_as_text(spark, tmp_path):
    (tmp_path / "i.yaml").write_text("issuers:\n- id: yes\n  name: Y\n  list_urls: [http://y/cards]\n- id: b\n  cards: [{name: N, url: http://b/n}]\n")
    rows = catalog.issuers(spark, str(tmp_path / "i.yaml"))
    assert [r.issuer_id for r in rows.orderBy("pos").collect()] == ["True", "b"]
    got = frontier.by_precedence(frontier.gather(*catalog.frontier_sources(rows)))
    assert {(r.url, r.force_card_name) for r in got.collect()} == {("http://y/cards", None), ("http://b/n", "N")}


def test_sitemap(spark):
    xml = "<loc> http://x/card-a </loc><loc>http://x/about</loc>"
    assert spark.range(1).select(catalog.sitemap_urls(F.lit(xml)).alias("u")).first().u == ["http://x/card-a"]


def test_fetch_keeps_prefetched_and_reports_errors(spark):
    def transport(url, headers, timeout):
        raise OSError("down")

    rows = spark.createDataFrame([("http://a", "<p>held</p>"), ("http://b", None)], "url string, prefetched_html string")
    got = {r.url: r for r in fetching.fetch(rows, fetching.Direct(gap_s=0, attempts=1), transport, 2).collect()}
    assert got["http://a"].ok and got["http://a"].text == "held"
    assert not got["http://b"].ok and "down" in got["http://b"].error


def test_batch_runs_once_over_unchanged_pages(spark, tmp_path):
    def keep(df, name):
        path = str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    html = "<p># Alpha Gold Credit Card</p><p>A Visa credit card. Annual fee: ₹500.</p>" + "<p>filler text</p>" * 20
    fetched = spark.createDataFrame([("https://a.example/cards/alpha", "alpha", "Alpha", False, None, None, None, False, html, None, 1)], "url string, issuer_id string, issuer_name string, is_listing boolean, force_card_name string, force_category string, force_network string, is_discovery boolean, html string, etag string, seq long")
    known = spark.createDataFrame([], "card_id string, first_seen_at string")
    ledger = spark.createDataFrame([], "url string, last_seen_at string, raw_text_sha256 string, etag string")
    from tessera.operators.extract import cards, with_ids
    from tessera.operators.pages import to_pages

    shape = with_ids(cards(to_pages(fetched).withColumnRenamed("url", "source_url")), "t").drop("pos")
    known = spark.createDataFrame([], shape.schema)
    one = run_batch(fetched, known, ledger, "t1", keep)
    got = one.cards.collect()
    assert [(r.card_id, r.fees.annual_fee_inr, r.network) for r in got] == [("alpha__alpha-gold-credit-card", 500.0, "Visa")]
    assert one.published.first().errors == []
    again = run_batch(fetched, one.cards, one.ledger, "t2", keep)
    assert again.cards.collect()[0].last_scraped_at == "t1" and again.changes.isEmpty()
