from pyspark.sql import functions as F

from tessera.functions import text, urls


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_numbers(spark):
    n = lambda s, u=None: value(spark, text.number(F.lit(s), F.lit(u) if u else None))
    assert n("1,00,000") == 100000
    assert n("2", "lakh") == 200000
    assert n("1.5", "crore") == 15000000
    assert n("1.2.3") is None and n("") is None and n(",") is None


def test_slug(spark):
    assert value(spark, text.slug(F.lit("  "))) == "unknown"
    assert value(spark, text.slug(F.lit("Tata Neu!"))) == "tata-neu"
    assert value(spark, text.slug(F.lit(None).cast("string"))) == "unknown"
    assert value(spark, text.slug(F.lit("A b"), "_", None)) == "a_b"


def test_tracking_parameters_go(spark):
    clean = lambda u: value(spark, urls.without_tracking(F.lit(u)))
    assert clean("http://x/a?UTM_SOURCE=z&q=1") == "http://x/a?q=1"
    assert clean("http://x/a?q=&ref=y") == "http://x/a"
    assert clean("http://x/a?a=1&b=2&a=3") == "http://x/a?a=1&a=3&b=2"
    assert clean("http://x/a") == "http://x/a"


def test_resolve(spark):
    join = lambda h: value(spark, urls.resolve(F.lit("https://h.x/a/b/c?q=1#f"), F.lit(h)))
    assert join("d") == "https://h.x/a/b/d"
    assert join("../d#z") == "https://h.x/a/d"
    assert join("./d/./e") == "https://h.x/a/b/d/e"
    assert join("/r?s=1") == "https://h.x/r?s=1"
    assert join("//o.y/p") == "https://o.y/p"
    assert join("?s=2") == "https://h.x/a/b/c?s=2"
    assert join("") == "https://h.x/a/b/c?q=1"
    assert join("mailto:a@b") == "mailto:a@b"


def test_may_fetch(spark):
    ok = lambda u, d=False: value(spark, urls.may_fetch(F.lit(u), F.lit(d)))
    assert not ok("https://b.in/terms-x") and ok("https://b.in/premier-card")
    assert not ok("https://b.in/a.PDF") and not ok("https://b.in/faq/x")
    assert not ok("https://b.in/card", True) and ok("https://www.cardexpert.in/card", True)


def test_same_site_keeps_names_that_start_with_w(spark):
    assert value(spark, urls.same_site(F.lit("https://www.wise.com/a"), F.lit("https://wise.com/b")))
    assert not value(spark, urls.same_site(F.lit("https://wise.com"), F.lit("https://ise.com")))


def test_snippet_cuts_at_a_word(spark):
    assert value(spark, text.snippet(F.lit("one two three four"), 10)) == "one two"
    assert value(spark, text.snippet(F.lit("[label](http://x) and **more**"))) == "label and more"
    assert value(spark, text.snippet(F.lit(None).cast("string"))) is None
