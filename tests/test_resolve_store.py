from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import changes, enrich, migrate, reports, resolve, store
from tessera.operators.registry import Registry


def test_alike_names():
    assert resolve.alike("X Card", "X Credit Card") and resolve.alike("x card", "X CARD")
    assert not resolve.alike("", "X Card") and not resolve.alike("Alpha Card", "Beta Card")


@given(st.text("ab ", max_size=12), st.text("ab ", max_size=12))
@settings(max_examples=50, deadline=None)
def test_ratio_is_symmetric(a, b):
    assert abs(resolve.token_set_ratio(a, b) - resolve.token_set_ratio(b, a)) < 1e-9


def test_collapse_keeps_the_earliest(spark):
    rows = [("i", "X Card", 1), ("i", "X Credit Card", 2), ("i", "X Gold Card", 3), ("j", "X Card", 4)]
    got = resolve.collapse_names(spark.createDataFrame(rows, "issuer_id string, card_name string, seq long"))
    assert {(r.seq, r.kept_by) for r in got.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}


def test_fullest_tie_goes_to_the_earlier(spark):
    rows = [("a", None, "x", 1), ("a", "y", None, 2), ("b", "", None, 3)]
    got = {r.card_id: r for r in resolve.fullest(spark.createDataFrame(rows, "card_id string, p string, q string, seq long")).collect()}
    assert got["a"].seq == 1 and got["b"].seq == 3


def test_fill_keeps_zero_and_replaces_null_words(spark):
    base = spark.createDataFrame([(1, (0.0, "null"))], "k int, fees struct<a:double,b:string>")
    extra = spark.createDataFrame([(1, (5.0, "x"))], "k int, fees struct<a:double,b:string>")
    got = enrich.fill_records(base, extra, "k").first().fees
    assert got.a == 0 and got.b == "x"


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1")], "card_id string, v int, first_seen_at string")
    new = spark.createDataFrame([("b", None, "d2"), ("c", 3, "d2")], "card_id string, v int, first_seen_at string")
    once = store.upsert(old, new)
    assert {tuple(r) for r in once.collect()} == {("a", 1, "d1"), ("b", None, "d1"), ("c", 3, "d2")}
    assert {tuple(r) for r in store.upsert(once, new).collect()} == {tuple(r) for r in once.collect()}


def test_change_types(spark):
    watched = ("fees.annual_fee_inr", "rewards.base_rate_pct", "status")
    kind = "card_id string, source_url string, fees struct<annual_fee_inr:double>, rewards struct<base_rate_pct:double>, status string"
    old = spark.createDataFrame([("a", "u", (1.0,), (2.0,), "active"), ("b", "u", (None,), (2.0,), "active")], kind)
    new = spark.createDataFrame([("a", "u", (2.0,), (3.0,), "discontinued"), ("b", "u", (5.0,), (1.0,), "active")], kind)
    got = {(r.card_id, r.field): r.change_type for r in changes.changes(old, new, "t", watched).collect()}
    assert got == {
        ("a", "fees.annual_fee_inr"): "devaluation", ("a", "rewards.base_rate_pct"): "change", ("a", "status"): "devaluation",
        ("b", "fees.annual_fee_inr"): "change", ("b", "rewards.base_rate_pct"): "devaluation",
    }


def test_registry_last_one_counts(spark):
    pages = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "issuer_id string, x int")
    plug_ins = Registry()
    plug_ins.register(["a"], lambda p: p.withColumn("by", F.lit("one")))
    plug_ins.register(["a"], lambda p: p.withColumn("by", F.lit("two")))
    got = plug_ins.extract(pages, lambda p: p.withColumn("by", F.lit("rest")))
    assert {(r.x, r.by) for r in got.collect()} == {(1, "two"), (2, "rest"), (3, "rest")}


def test_errors_name_failed_checks(spark):
    kind = "card_id string, issuer_id string, card_name string, category string, source_url string, status string, network string, segment string, card_material string, milestones array<struct<spend_inr:double,period:string>>, perks array<struct<kind:string>>, partner_offers array<struct<partner:string>>"
    bad = spark.createDataFrame([("a", None, "n", "x", "u", "active", "visa", None, None, [(None, "annual")], None, None)], kind)
    assert migrate.validated(bad).first().errors == ["category: not allowed", "issuer_id: required", "milestones[0].spend_inr: required"]


def test_best_match_is_that_of_all_pairs(spark):
    words = ["alpha", "beta", "gold", "card", "plus"]
    named = lambda i: " ".join(w for j, w in enumerate(words) if i >> j & 1)
    kind = "{} long, brand string, card_name string{}"
    rules = [(i, "b" if i % 3 else "a", named(i)) for i in range(32)] + [(40, "only", "alpha"), (41, "only", "zeta"), (42, "none", "alpha"), (43, "only", None), (44, None, "alpha")]
    others = [(i, "b" if i % 2 else "a", named(i * 7 % 32), 100 - i) for i in range(1, 40)] + [(50, "only", "alpha beta", 1), (51, None, "alpha", 2)]
    got = resolve.best_match(spark.createDataFrame(rules, kind.format("id", "")), spark.createDataFrame(others, kind.format("other_id", ", seq long")), "brand")
    word_sets = spark.createDataFrame([(n,) for n in {r[2] for r in rules} | {o[2] for o in others}], "n string").select("n", text.word_set(F.col("n")).alias("w")).collect()
    sets = {r.n: set(r.w or []) for r in word_sets}
    want = set()
    for i, brand, name in rules:
        found = sorted((-len(sets[name] & sets[o[2]]), o[3], o[0]) for o in others if brand is not None and o[1] == brand)
        if found and (found[0][0] < 0 or len(found) == 1):
            want.add((i, found[0][2], -found[0][0]))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_earliest_of_equals_may_be_told_by_page_and_place(spark):
    rows = [("a", "late", (2, 0)), ("a", "early", (1, 9))]
    assert resolve.fullest(spark.createDataFrame(rows, "card_id string, p string, seq struct<s:long,pos:int>")).first().p == "early"


def test_health_records_and_report(spark):
    rows = [("a", "A", ["http://a/x#1", "http://a/x#2", "http://a/y"], "http://a/x"), ("b", "B", None, None), ("c", "C", [None], "http://c/s")]
    got = reports.health_records(spark.createDataFrame(rows, "issuer_id string, issuer_name string, list_urls array<string>, sitemap_url string")).collect()
    assert sorted((r.issuer_id, r.url_type, r.url) for r in got) == [("a", "list_url", "http://a/x"), ("a", "list_url", "http://a/y"), ("a", "sitemap_url", "http://a/x"), ("c", "sitemap_url", "http://c/s")]
    checked = [("a", "u1", "BROKEN", "TIMEOUT", 500, None), ("b", "u2", "BROKEN", None, 404, "not found"), ("b", "u3", "BROKEN", None, 200, "access denied"), ("b", "u4", "OK", None, 200, None), ("a", "u5", "OK", None, None, None)]
    told = reports.health_report(spark.createDataFrame(checked, "issuer_id string, url string, category string, error string, status int, phrase string")).collect()
    assert {(r.level, r.category, r.reason, r.urls, r.issuers) for r in told} == {
        ("reason", "BROKEN", "TIMEOUT", 1, 1), ("reason", "BROKEN", "HTTP 404", 1, 1), ("reason", "BROKEN", "says: access denied", 1, 1), ("reason", "OK", None, 2, 2),
        ("category", "BROKEN", None, 3, 2), ("category", "OK", None, 2, 2), ("all", None, None, 5, 2),
    }
