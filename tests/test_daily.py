"""The daily run whole: every stage's table over three days, bounds, forced runs, and a run that dies."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.registry import Registry
from tessera.plans.daily import Options, Versions, run_daily

FRONTIER = """url string, issuer_id string, issuer_name string, is_listing boolean, force_card_name string, force_category string,
    force_network string, is_discovery boolean, prefetched_html string, seq long"""
PAD = "filler words of the page. " * 20


def row(url, seq, issuer="alpha", **more):
    held = {"is_listing": False, "force_card_name": None, "force_category": None, "force_network": None, "is_discovery": False, "prefetched_html": None, **more}
    return (url, issuer, issuer.title() if issuer else None, *held.values(), seq)


def card(name, rest="A Visa credit card."):
    return f"# {name} Credit Card\n{rest}\n{PAD}"


SITE = {
    "https://a.example/cards/gold": card("Alpha Gold"),
    "https://a.example/cards/gold/fees-and-charges": f"Annual fee: ₹500. {PAD}",
    "https://a.example/cards/gold-again": card("Alpha Gold", "A Visa credit card. Annual fee: ₹700."),
    "https://a.example/cards/silver": card("Alpha Silver", "A Visa credit card. Annual fee: ₹300."),
    "https://a.example/cards/gone": f"Page Not Found\n{PAD}",
    "https://a.example/cards/short": "credit card",
}


@pytest.fixture
def served(spark):
    def over(site):
        stored = spark.createDataFrame([(u, x) for u, x in site.items()], "url string, text string")

        def fetch(asked):
            rows = asked.join(stored, "url", "left").withColumn("text", F.coalesce("prefetched_html", "text"))
            return rows.select("url", F.col("text").alias("html"), "text", F.lit("tag").alias("etag"), F.col("text").isNotNull().alias("ok"))

        return fetch

    return over


def test_stages_and_days(spark, tmp_path, served):
    rows = spark.createDataFrame([row(u, i) for i, u in enumerate(u for u in SITE if "charges" not in u)] + [row("https://a.example/login", 9), row("https://a.example/cards/none", 10), row(None, 11)], FRONTIER)
    suffixes = spark.createDataFrame([("alpha", "/fees-and-charges", 0)], "issuer_id string, suffix string, pos int")
    v = Versions(spark, str(tmp_path))
    assert v.read("cards") is None and run_daily(v, rows, served(SITE), "t1", suffixes) == 1
    urls = lambda name, c="url": sorted(r[c].rsplit("/", 1)[-1] for r in v.read(name).collect())
    assert urls("frontier") == ["gold", "gold-again", "gone", "none", "short", "silver"]
    assert sorted(r.url.rsplit("/", 1)[-1] for r in v.read("fetched").where("ok").collect()) == ["gold", "gold-again", "gone", "short", "silver"]
    assert urls("pages", "source_url") == ["gold", "gold-again", "silver"]
    gold = v.read("pages").where(F.col("source_url").endswith("/gold")).first()
    assert "FEES AND CHARGES" in gold.markdown and "₹500" in gold.markdown
    assert {(r.source_url.rsplit("/", 1)[-1], r.step, r.status) for r in v.read("attempts").collect()} == {(u, "rules", "ok") for u in ("gold", "gold-again", "silver")}
    cards = {r.card_name: r for r in v.read("cards").collect()}
    assert {n: r.fees.annual_fee_inr for n, r in cards.items()} == {"Alpha Gold Credit Card": 500.0, "Alpha Silver Credit Card": 300.0}
    assert v.read("added").count() == 2 and v.read("changes").isEmpty() and v.read("rejected").isEmpty()
    assert v.read("catalogue").count() == 2 and v.read("published").count() == 2 and v.read("ledger").count() == 3

    dearer = {**SITE, "https://a.example/cards/silver": card("Alpha Silver", "A Visa credit card. Annual fee: ₹900.")}
    assert run_daily(v, rows, served(dearer), "t2", suffixes) == 2
    assert urls("pages", "source_url") == ["silver"] and v.read("added").isEmpty()
    assert [(r.field, r.old_value, r.new_value, r.change_type) for r in v.read("changes").collect()] == [("fees.annual_fee_inr", "300.0", "900.0", "devaluation")]
    silver = v.read("cards").where("card_name like '%Silver%'").first()
    assert (silver.first_seen_at, silver.last_scraped_at) == ("t1", "t2") and v.read("cards").count() == 2
    assert v.read("cards", 1).where("card_name like '%Silver%'").first().fees.annual_fee_inr == 300.0

    def dies(asked):
        raise OSError("no site")

    with pytest.raises(OSError):
        run_daily(v, rows, dies, "t3", suffixes)
    assert v.latest() == 2 and v.read("cards").count() == 2
    late = v.begin()
    late.keep(spark.range(1), "x")
    assert run_daily(v, rows.limit(0), served(dearer), "t3") == 3 and v.read("cards").count() == 2 and v.read("ledger").count() == 3
    with pytest.raises(RuntimeError):
        late.commit()


def test_bounds_force_and_provider(spark, tmp_path, served):
    site = {f"https://b.example/cards/{n}": card(f"Beta {n.title()}") for n in ("one", "two", "three")} | {"https://b.example/cards/odd": f"nothing known here. {PAD}"}
    rows = spark.createDataFrame([row(u, i, "beta") for i, u in enumerate(site)], FRONTIER)
    v = Versions(spark, str(tmp_path / "a"))
    run_daily(v, rows, served(site), "t1", options=Options(most=2))
    assert sorted(r.source_url[-3:] for r in v.read("records").collect()) == ["one", "two"] and v.read("ledger").count() == 2
    more = spark.createDataFrame([row("https://g.example/cards/four", 4, "gamma"), row("https://g.example/cards/five", 5, "gamma"), row("https://b.example/cards/six", 9, "beta")], FRONTIER)
    site["https://g.example/cards/four"] = card("Gamma Four")
    plug = Registry()
    plug.register(["gamma"], lambda p: p.sparkSession.createDataFrame([], v.read("found").drop("reason", "seq").withColumn("pos", F.lit(0)).schema), lambda u: u.endswith("five"))
    no_answer = lambda prompts: [None] * len(prompts)
    run_daily(v, rows.unionByName(more), served(site), "t2", plug_ins=plug, provider=no_answer, options=Options(first=5, force=True))
    assert sorted(r.url[-4:] for r in v.read("frontier").collect()) == ["/odd", "/one", "/two", "four", "hree"]
    assert v.read("cards").count() == 3 and v.read("purged").isEmpty()
    ruled = {(u, "rules", "ok") for u in ("one", "two", "ree")}
    assert {(r.source_url[-3:], r.step, r.status) for r in v.read("attempts").collect()} == ruled | {("odd", "provider", "retry"), ("our", "extractor", "empty")}
    assert v.read("ledger").count() == 4  # the page that got no answer comes again
