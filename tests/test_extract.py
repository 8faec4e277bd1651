from pyspark.sql import functions as F

from tessera.operators import extract, names


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_fees(spark):
    f = lambda s: value(spark, extract.fees(F.lit(s)))
    assert f("Joining Fee: Nil").joining_fee_inr == 0
    assert f("Fee waiver on 999") is None
    assert f("Lifetime free").renewal_fee_inr == 0
    assert f("2% forex markup").fx_markup_pct == 2
    assert f("nothing here") is None


def test_category_named_in_text_beats_the_path(spark):
    c = lambda s, u: value(spark, extract.category(F.lit(s), F.lit(u)))
    assert c("a credit card", "https://x/debit-cards/y") == "credit"
    assert c("a page", "https://x/debit-cards/y") == "debit"
    assert c("a page", "https://x/business/y") == "business"


def test_lounge_periods(spark):
    v = lambda s: value(spark, extract.lounge(F.lit(s)))
    assert v("2 domestic lounge visits per quarter").domestic_visits_year == 8
    assert v("2 domestic lounge visits per half-year").domestic_visits_year == 4
    assert v("3 lounge visits").domestic_visits_year == 3


def test_accelerated_rates_drop_repeats(spark):
    md = "5% cashback on Amazon.\n5% cashback on leading brands Amazon.\n3% cashback on all spends.\n2X points on dining."
    got = value(spark, extract.rewards(F.lit(md), F.lit("none"))).accelerated
    assert [(x.category, x.rate_pct) for x in got] == [("Amazon", 5.0), ("dining", 6.0)]


def test_names_from_urls(spark):
    n = lambda u: value(spark, names.url_name(F.lit(u)))
    assert n("https://b/credit-cards/millennia-credit-card") == "Millennia Credit Card"
    assert n("https://b/x/tata-card-apply-for-tata-neu-plus-credit-card") == "Tata Neu Plus Credit Card"
    assert n("https://b/x/gold-card.html") == "Gold Card"
    assert n("https://b/x/about-us") is None


def test_valid_names(spark):
    r = lambda s: value(spark, names.reject_reason(F.lit(s)))
    assert r("Regalia Gold Credit Card") is None
    assert r("Credit Card") == "no_product" and r("x" * 101) == "long" and r("What card?") is not None
    assert r("Travel Credit Card") == "generic_kind" and r("Gold") == "no_card" and r("") == "empty"


def test_sections_take_third_level_headings(spark):
    md = "intro\n### Alpha Credit Card\na\n### Beta Debit Card\nb"
    rows = extract.sections(spark.createDataFrame([(1, md)], "id int, markdown string")).orderBy("pos").collect()
    assert [r.section_name for r in rows] == ["Alpha Credit Card", "Beta Debit Card"]


def test_fees_beside_waivers_and_other_amounts(spark):
    said = {
        "Joining fee of Rs. 500 is waived if you spend Rs. 50,000 in 90 days.": (500, None, None, 50_000),
        "Annual fee ₹500, reversed on spends of ₹1,00,000": (None, 500, None, 100_000),
        "Spend ₹1,00,000 in a year and the annual fee of ₹500 is reversed": (None, 500, None, 100_000),
        "On annual spends of ₹2 lakh, annual fee of ₹2,999 is waived": (None, 2999, None, 200_000),
        "Joining fee ₹500 and annual fee ₹1,000": (500, 1000, None, None),
        "Joining/Annual fee: ₹999 + GST": (999, 999, None, None),
        "Joining fee nil, renewal fee ₹750": (0, None, 750, None),
        "Annual fee (2nd year onwards): INR 2500": (None, 2500, None, None),
        "Annual fee waived on spending 1.5 crore": (None, None, None, 15_000_000),
        "Annual fee: Nil": (None, None, 0, None),
        "No joining fee": (0, None, None, None),
        "Membership fee waiver on spends of 3 lakhs": (None, None, None, 300_000),
        "1% fuel surcharge waiver on spends between ₹400 and ₹900": (None, None, None, None),
        "Earn 4X points. Annual spends get ₹500 cashback": None,
    }
    rows = spark.createDataFrame(list(enumerate(said)), "i int, md string").select("i", extract.fees(F.col("md")).alias("f")).collect()
    got = {r.i: r.f and (r.f.joining_fee_inr, r.f.annual_fee_inr, r.f.renewal_fee_inr, r.f.fee_waiver_spend_inr) for r in rows}
    assert got == dict(enumerate(said.values()))


def test_perk_kinds(spark):
    said = {
        "golf": "4 golf games a year", "golf_simulator": "Golf simulator sessions", "movie": "Buy one movie ticket, get one free", "dining": "Up to 20% off at partner restaurants", "concierge": "24x7 concierge",
        "spa": "Spa sessions", "hotel": "Complimentary hotel night", "subscription": "Complimentary Amazon Prime membership", "railway_lounge": "Railway lounge visits", "roadside_assist": "Roadside assistance",
        "annual_voucher": "An annual travel voucher", "forex_perk": "Zero forex markup", "contactless": "Contactless payments", "virtual_card": "A virtual card at once", "emi_conversion": "Convert spends into EMI",
    }
    got = [[p.kind for p in r.p or []] for r in spark.createDataFrame([(i, v) for i, v in enumerate(said.values())], "i int, md string").orderBy("i").select(extract.perks(F.col("md")).alias("p")).collect()]
    assert got == [["golf"], ["golf", "golf_simulator"], *[[k] for k in list(said)[2:]]]
    assert value(spark, extract.perks(F.lit("We charge a forex fee\nHotels near you\nThe movie page"))) is None


def test_products_called_by_verbs_are_products(spark):
    good = ["Explore Gold Credit Card", "Happy Gold Credit Card", "Turn Key Credit Card", "Set Sail Travel Credit Card", "Bank of Baroda Select Credit Card", "The Club Credit Card", "Regalia Gold Credit Card"]
    bad = ["Explore our credit cards card", "Happy to announce a card", "Turn your spends into card points", "Set or reset your card", "How to use a card", "Best Credit Card", "Apply for HDFC card", "Get your card", "Lost or stolen card", "Manage Credit Card", "Important: card update", "Gold Card login"]
    rows = spark.createDataFrame([(x,) for x in good + bad], "n string").select("n", names.reject_reason(F.col("n")).alias("why")).collect()
    assert [r.n for r in rows if r.why is None] == good
