"""Product facts from page text, as Column expressions: a page is one row, a fact one field, nothing is shuffled.

A text is cut into clauses (lines and sentences) once. A fact is looked for in the first clause that speaks of it,
which is told by words of every class the fact needs; its amount is the first one behind the fact's own word. Every
extractor takes the text Column and returns a struct, array or scalar that is null where the page says nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import INVITATIONS, clauses, every, filled, first, has, let, nonempty, number, replace, rx, slug, snippet
from tessera.operators import names
from tessera.operators.card_schema import CARD
from tessera.session import spread

def _struct(**fields: Column) -> Column:
    """A struct of the fields, null where all of them are."""
    whole = F.struct(*[c.alias(n) for n, c in fields.items()])
    return let(whole, lambda s: F.when(reduce(lambda a, b: a | b, (s[n].isNotNull() for n in fields)), s))


def some(found: Column) -> Column:
    """Null for an empty array."""
    return F.when(F.size(found) > 0, found)


def distinct_lower(texts: Column) -> Column:
    """The first of texts that differ in case only."""
    both = lambda held: F.struct(held.alias("t"), F.transform(held, lambda x: F.lower(x)).alias("low"))
    return let(let(texts, both), lambda b: F.filter(b["t"], lambda x, i: F.array_position(b["low"], F.lower(x)) == i + 1))


def _flag(test: Column) -> Column:
    return F.when(test, F.lit(True))


def _any(words: tuple[str, ...]) -> str:
    """Words that begin so; a blank stands for any space or hyphen, a final full stop for the word's end."""
    begun = (w.replace(".", r"\b").replace(" ", r"[\s-]*") for w in words)
    # the look at the first letter decides nothing, but costs far less than a word's edge at every place of a text
    return rf"(?=[{''.join(sorted({w[0] for w in words}))}])\b(?:{'|'.join(begun)})"


def says(clause: Column, *classes: tuple[str, ...]) -> Column:
    """Whether a clause has a word of each class."""
    low = F.lower(clause)  # plain patterns over lower-case text run several times faster than case-blind ones
    return reduce(lambda a, b: a & b, (low.rlike(_any(c)) for c in classes))


def behind(clause: Column, words: tuple[str, ...]) -> Column:
    """What stands behind the first of the words; null without one."""
    return nonempty(F.regexp_extract(clause, rf"(?is){_any(words)}(.*)", 1))


def _money(marked: bool) -> str:
    mark = r"(?:₹|\brs\b\.?|\binr\b)\s*"
    return rf"{mark if marked else f'(?:{mark})?'}(\d[\d,]*(?:\.\d+)?)(?![\d%]|\s*%)\s*(lakhs?|lacs?|crores?|cr)?\b"


def rupees(text: Column, marked: bool = True) -> Column:
    """The first amount of a text in rupees, lakh and crore applied; ``marked``: only with the currency's sign or name."""
    pattern = f"(?i){_money(marked)}"
    return number(F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))


def percent(text: Column) -> Column:
    return number(first(text, r"(\d+(?:\.\d+)?)\s*%"))


def _cut(md: Column, held: Column | None) -> Column:
    """A text's clauses, which are ``held`` where they were cut before."""
    return clauses(md) if held is None else held


def _found(held: Column, value) -> Column:
    """The first value that is not null over clauses."""
    return F.try_element_at(F.filter(F.transform(held, value), lambda x: x.isNotNull()), F.lit(1))


def _spoken(held: Column, *classes: tuple[str, ...]) -> Column:
    """The clauses with a word of each class."""
    return F.filter(held, lambda c: says(c, *classes))


#: Classes of words.
FEE, NONE, GONE, WAIVED, SPENT = ("fee", "membership"), ("nil.", "free.", "zero.", "no.", "not.", "waived."), ("nil.", "free.", "zero."), ("waive", "waiver", "reversal", "reversed"), ("spend", "spent")
JOINING, ANNUAL, RENEWAL, ADD_ON = ("joining", "join."), ("annual", "yearly"), ("renewal",), ("add on", "addon", "supplementary")
ADVANCE, INTEREST, FOREIGN = ("cash advance",), ("finance charge", "interest"), ("forex", "foreign", "cross currency", "markup", "mark up")
TAXED, TAX = ("plus", "exclusive", "excluding", "extra", "additional", "applicable"), ("gst.", "tax")
LIFETIME, FUEL = ("lifetime free.", "life time free.", "free for life."), ("fuel",)
#: Every charge beside the main fees speaks one of these words, so a page's other clauses are passed over once.
CHARGES = (*ADVANCE, *INTEREST, *FOREIGN, *TAX, *LIFETIME, *FUEL)
HOME, ABROAD, QUARTER, HALF, GUEST = ("lounge",), ("international", "outside india", "overseas"), ("quarter",), ("half year", "biannual", "bi annual"), ("guest", "companion")


# ── fees ──────────────────────────────────────────────────────────────────────────────────────────


def fees(md: Column, held: Column | None = None) -> Column:
    """Fees in rupees, charges in per cent. A fee said to be nil or free is 0; lifetime free fills both main fees."""
    return let(_cut(md, held), lambda held: let(_spoken(held, CHARGES), lambda charged: _fees(held, charged)))


def _amounts(clause: Column, marked: bool) -> Column:
    """The amounts of a clause, each with the words since the one before it: an amount belongs to what leads up to it."""
    pattern = F.lit(rf"(?is)(.*?){_money(marked)}")
    group = lambda i: F.regexp_extract_all(clause, pattern, F.lit(i))
    return F.transform(F.arrays_zip(group(1).alias("lead"), group(2).alias("n"), group(3).alias("unit")), lambda x: F.struct(x["lead"], number(x["n"], x["unit"]).alias("inr")))


def _fees(held: Column, charged: Column) -> Column:
    """From the clauses and those of them that have a word of ``CHARGES``.

    An amount is a fee's if its lead names the fee and nothing behind that name takes it back or asks for a spend."""

    def whole(told: Column) -> Column:
        def named(word: tuple[str, ...]) -> Column:
            own = lambda lead: let(behind(lead, word), lambda t: says(t, FEE) & ~says(t, GONE) & ~says(t, WAIVED) & ~says(t, SPENT))
            found = F.transform(told, lambda c: F.try_element_at(F.filter(c["marked"], lambda x: F.coalesce(own(x["lead"]), F.lit(False))), F.lit(1))["inr"])
            return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))

        parts = lambda c: F.concat(F.transform(c["marked"], lambda x: x["lead"]), F.array(c["rest"]))
        free = lambda word: F.exists(told, lambda c: F.exists(parts(c), lambda x: says(x, word, FEE, NONE) & ~says(x, SPENT)))
        condition = lambda c: F.filter(_amounts(c["text"], False), lambda x: (x["inr"] >= 1000) & (says(x["lead"], WAIVED) | says(x["lead"], SPENT)))
        waivers = F.filter(told, lambda c: says(c["text"], WAIVED) & (says(c["text"], SPENT) | says(c["text"], FEE)))
        asked = F.transform(waivers, lambda c: F.try_element_at(condition(c), F.lit(1))["inr"])
        extra = F.transform(_told(told, ADD_ON, FEE), lambda c: rupees(behind(c["text"], ADD_ON), False))
        return F.struct(
            named(JOINING).alias("joining"), named(ANNUAL).alias("annual"), named(RENEWAL).alias("renewal"),
            free(JOINING).alias("no_joining"), (free(RENEWAL) | free(ANNUAL)).alias("no_renewal"),
            F.try_element_at(F.filter(asked, lambda x: x.isNotNull()), F.lit(1)).alias("waiver"), F.try_element_at(F.filter(extra, lambda x: x.isNotNull()), F.lit(1)).alias("add_on"),
        )

    rate = lambda word: _found(charged, lambda c: percent(behind(c, word)))
    lifetime = F.exists(charged, lambda c: says(c, LIFETIME))
    spoken = F.filter(held, lambda c: says(c, (*FEE, *WAIVED)))
    last = rf"(?is).*{_money(True)}"
    told = F.transform(spoken, lambda c: F.struct(c.alias("text"), _amounts(c, True).alias("marked"), F.regexp_replace(c, last, "").alias("rest")))
    markup = _found(charged, lambda c: let(F.when(says(c, FOREIGN), F.coalesce(percent(behind(c, FOREIGN)), percent(c))), lambda x: F.when((x > 0) & (x <= 10), x)))
    fuel = F.try_element_at(_spoken(charged, FUEL, ("surcharge",), WAIVED), F.lit(1))
    return let(
        let(told, whole),
        lambda f: _struct(
            joining_fee_inr=F.coalesce(f["joining"], F.when(f["no_joining"] | lifetime, 0.0)),
            annual_fee_inr=f["annual"],
            renewal_fee_inr=F.coalesce(f["renewal"], F.when((f["annual"].isNull() & f["no_renewal"]) | lifetime, 0.0)),
            fee_waiver_spend_inr=f["waiver"],
            addon_card_fee_inr=f["add_on"],
            cash_advance_fee_pct=rate(ADVANCE),
            finance_charge_pct_mo=rate(INTEREST),
            fx_markup_pct=markup,
            fuel_surcharge_waiver=nonempty(snippet(fuel)),
            gst_extra=_flag(F.exists(charged, lambda c: says(c, TAX) & (says(c, TAXED) | has(c, r"\+\s*gst\b")))),
        ),
    )


def _told(told: Column, *classes: tuple[str, ...]) -> Column:
    return F.filter(told, lambda c: says(c["text"], *classes))


# ── rewards ───────────────────────────────────────────────────────────────────────────────────────

#: Rupees a point, and the currency's name, by issuer.
POINT_VALUES = {
    "hdfc": 0.25, "icici": 0.25, "sbi_card": 0.25, "kotak": 0.25, "axis": 0.20, "indusind": 1.00, "rbl": 0.25,
    "yes": 0.25, "idfc_first": 0.25, "federal": 0.25, "au_sfb": 0.25, "standard_chartered": 0.25, "hsbc": 0.25,
    "amex": 0.50, "onecard": 0.10, "scapia": 0.50,
}
CURRENCIES = {
    "hdfc": "Reward Points", "icici": "Reward Points", "sbi_card": "Reward Points", "kotak": "Kotak Points",
    "axis": "eDGE Miles", "indusind": "IndusMiles", "rbl": "Reward Points", "amex": "Membership Rewards",
    "onecard": "1FC Points", "scapia": "Scapia Coins", "idfc_first": "Reward Points",
}
DEFAULT_POINT = 0.25
#: Words that do not make a spend category, and words that two categories may share.
GENERIC_SPEND = (
    "all", "at", "categories", "category", "every", "everywhere", "for", "merchant", "on", "other", "purchase", "purchases", "retail", "spend", "spends", "spent", "the", "transaction",
    "transactions", "your",
)
STOP_WORDS = ("on", "at", "the", "a", "an", "and", "or", "of", "in", "for", "to", "with", "across", "select", "all", "up")
#: What may be earned.
UNITS = ("cashback", "cash back", "coin", "mile", "point", "reward")
#: Words of the published ways to redeem.
PLACES = tuple(dict.fromkeys(w.removesuffix("s") for way in CARD["properties"]["rewards"]["properties"]["redemption_modes"]["items"]["enum"] for w in way.split("_") if len(w) > 3))
#: A number of units for an amount: number, unit, amount, what follows.
_FOR_SPEND = rf"(\d+(?:\.\d+)?)((?:\s+[\w-]+){{0,4}}?)\s*(?:/|\b(?:per|every|each)\b)\s*(?:₹|rs\.?|inr)?\s*(\d[\d,]*)(.*)"
#: A share or a multiple on a category: number, sign, category.
_ON = r"(\d+(?:\.\d+)?)\s*(%|x\b)[\w\s-]{0,30}?\bon\s+([^,(*]{3,60})"


def _by_issuer(issuer: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), issuer)


def _lower_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _own_words(category: Column) -> Column:
    """What a category names beyond words that name none."""
    return F.filter(_lower_words(category), lambda w: ~w.isin(*GENERIC_SPEND))


def _candidate(category: Column, rate: Column, cap: Column, notes: Column) -> Column:
    return F.struct(category.alias("category"), rate.cast("double").alias("rate_pct"), cap.cast("double").alias("cap_inr"), notes.cast("string").alias("notes"))


def _category(tail: Column) -> Column:
    """A category from what follows an earning: without its first linking words and from a limit or bracket on."""
    cut = F.regexp_replace(tail, rx(r"[(,].*|\b(?:capped|up\s+to|subject|max(?:imum)?)\b.*", "is"), "")
    return F.btrim(replace(F.btrim(cut, F.lit(" :*–-.&/")), r"^(?:(?:spen[dt]s?|on|for)\s+)+"), F.lit(" :*–-.&/"))


def earn_lines(held: Column, point: Column) -> Column:
    """Clauses that give units for an amount: value in per cent of spend, unit, and whether it is the base rate."""

    def line(c: Column) -> Column:
        part = lambda i: F.regexp_extract(c, rx(_FOR_SPEND, "is"), i)
        return F.struct(number(part(1)).alias("n"), F.trim(replace(part(2), r"\s*\b(?:for|on)$")).alias("unit"), number(part(3)).alias("spend"), F.trim(part(4)).alias("tail"))

    def valued(m: Column) -> Column:
        back = has(m["unit"], "cash")
        ratio = m["n"] / m["spend"] * 100
        pct = F.when(back & (m["spend"] < 100), m["n"]).when(back, F.round(ratio, 4)).otherwise(F.round(F.coalesce(point, F.lit(DEFAULT_POINT)) * ratio, 4))
        category = _category(m["tail"])
        base = F.length(F.array_join(_own_words(category), "")) < 3
        notes = F.concat(F.regexp_replace(m["n"].cast("string"), r"\.0$", ""), F.lit(" "), m["unit"], F.lit(" per ₹"), m["spend"].cast("long").cast("string"))
        cap = rupees(behind(m["tail"], ("up to", "max", "maximum", "capped")), False)
        return F.struct(_candidate(category, pct, cap, notes).alias("c"), m["unit"].alias("unit"), base.alias("base"))

    stated = F.filter(held, lambda c: F.lower(c).rlike("/|per|every|each"))  # without which no line can match
    lines = F.filter(F.transform(stated, line), lambda m: (m["spend"] > 0) & says(m["unit"], UNITS))
    return F.transform(lines, valued)


def accelerated(earned: Column, held: Column, base_rate: Column) -> Column:
    """Category rates: earnings, shares, then multiples; of one category, or one rate and a shared word, the first."""

    def on(c: Column) -> Column:
        part = lambda i: F.regexp_extract(c, rx(_ON), i)
        times = F.lower(part(2)) == "x"
        rate = F.when(times, F.round(number(part(1)) * base_rate, 4)).otherwise(number(part(1)))
        return F.struct(_candidate(_category(part(3)), rate, F.lit(None), F.when(times, F.concat(part(1), F.lit("X points")))).alias("c"), times.alias("times"))

    told = let(F.transform(F.filter(held, lambda c: has(c, _ON) & ~says(c, ("redeem",))), on), lambda x: F.concat(F.filter(x, lambda m: ~m["times"]), F.filter(x, lambda m: m["times"])))
    every_one = F.concat(F.transform(F.filter(earned, lambda e: ~e["base"]), lambda e: e["c"]), F.transform(told, lambda m: m["c"]))
    good = F.filter(every_one, lambda c: c["rate_pct"].isNotNull() & F.length(c["category"]).between(3, 69) & (F.length(F.array_join(_own_words(c["category"]), "")) >= 3))
    words = lambda c: F.filter(_own_words(c["category"]), lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))
    alike = lambda a, b: (F.lower(a["category"]) == F.lower(b["category"])) | ((a["rate_pct"] == b["rate_pct"]) & F.arrays_overlap(words(a), words(b)))
    empty = F.array().cast("array<struct<category:string,rate_pct:double,cap_inr:double,notes:string>>")
    return let(F.aggregate(good, empty, lambda kept, c: F.when(F.exists(kept, lambda k: alike(k, c)), kept).otherwise(F.concat(kept, F.array(c)))), some)


def rewards(md: Column, issuer: Column, held: Column | None = None) -> Column:
    """Point value, base rate, currency, category rates, exclusions, redemption modes, expiry."""

    def whole(held: Column) -> Column:
        stated = _found(held, lambda c: F.when(says(c, ("point", "mile", "rp.")), number(first(c, r"\b1\b[^=:\d]*[=:]\D{0,5}(\d+(?:\.\d+)?)"))))
        point = F.coalesce(stated, _by_issuer(issuer, POINT_VALUES))
        return let(F.struct(held.alias("held"), point.alias("point"), earn_lines(held, point).alias("earned")), lambda x: _rewards(x["held"], issuer, x["point"], x["earned"]))

    return let(_cut(md, held), whole)


def _rewards(held: Column, issuer: Column, point: Column, earned: Column) -> Column:
    flat = _found(held, lambda c: F.when(says(c, ("cashback", "cash back"), ("all.",)), percent(c)))
    based = F.try_element_at(F.filter(earned, lambda e: e["base"]), F.lit(1))["c"]["rate_pct"]
    base_rate = F.coalesce(F.nullif(based, F.lit(0.0)), flat, based)
    unit = nonempty(F.try_element_at(earned, F.lit(1))["unit"])
    named = _found(held, lambda c: first(c, r"\b((?:reward|edge|indus|membership|kotak|cred|1fc|scapia)\s*(?:points?|miles?|coins?|rewards?)|cashback|neucoins)\b"))
    title = lambda c: F.initcap(replace(c, r"\s+", " "))
    currency = F.coalesce(F.when(~has(unit, "cash"), title(unit)), title(named), _by_issuer(issuer, CURRENCIES), F.when(flat.isNotNull(), "Cashback"))
    without = F.transform(_spoken(held, ("no reward", "no point", "not earn", "exclude", "excluding"), ("on.",)), lambda c: F.trim(behind(c, ("on.",))))
    given = F.transform(_spoken(held, ("redeem",)), lambda c: F.btrim(snippet(behind(c, ("for.", "at.", "against."))), F.lit(" .,")))
    modes = let(F.filter(given, lambda x: says(x, PLACES) & F.length(x).between(3, 60)), distinct_lower)
    return _struct(
        point_value_inr=point, base_rate_pct=base_rate, currency=currency, accelerated=accelerated(earned, held, base_rate),
        exclusions=some(F.filter(without, lambda x: x.isNotNull())), redemption_modes=some(F.slice(modes, 1, 8)),
        expiry_months=_found(held, lambda c: first(c, r"(\d+)\s*months?\b(?=.*\b(?:from|of)\b)").try_cast("int")),
    )


# ── benefits ──────────────────────────────────────────────────────────────────────────────────────

#: What a product gives or takes, by the names of its own parts; an invitation to click tells nothing.
WORTH = (*UNITS, "fee", "waiver", "lounge", "insurance", "welcome", "milestone", "voucher", "gift", "bonus", "discount", "fuel", "membership", "complimentary", "free.")
MENU = INVITATIONS
_VALUE = r"[₹%]|\b(?:rs\.?\s*\d|inr\b)"


def welcome(md: Column, held: Column | None = None) -> Column:
    """What the first clause on joining offers, if it tells a worth or is long enough to tell anything."""
    joins = ("welcome", "joining", "on activation", "first transaction", "first spend", "first swipe")
    given = (*WORTH, "benefit", "offer", "reward", "get.", "earn")

    def offer(c: Column) -> Column:
        rest = F.when(says(c, joins, given) & ~has(c, r"\bjoining\s+(?:and\s+\w+\s+)?fee"), behind(c, joins))
        return let(snippet(replace(rest, r"^\s*(?:benefits?|gifts?|bonus|offers?|rewards?|vouchers?)\b")), lambda t: F.when((F.length(t) >= 15) & ~says(t, MENU), t))

    return let(_found(_cut(md, held), offer), lambda t: F.when(has(t, _VALUE) | says(t, WORTH) | (F.length(t) >= 30), t))


def milestones(md: Column, held: Column | None = None) -> Column:
    """Clauses that promise something for an amount spent, the first of each amount; the period is what they say."""
    gains = ("get.", "earn", "receive", "enjoy", "unlock", "bonus", "complimentary", "worth", "voucher", "free.")

    def one(c: Column) -> Column:
        period = F.when(says(c, ("month",)), "monthly").when(says(c, QUARTER), "quarterly").when(says(c, ("annual", "year")), "annual")
        reward = F.coalesce(nonempty(snippet(behind(c, ("get.", "earn", "receive", "enjoy", "unlock")))), snippet(behind(c, gains)))
        return F.struct(rupees(behind(c, SPENT), False).alias("spend_inr"), reward.alias("reward"), F.lit(None).cast("double").alias("value_inr"), period.alias("period"))

    told = F.transform(_spoken(_cut(md, held), SPENT, gains), one)
    found = F.filter(told, lambda x: (x["spend_inr"] > 0) & (F.length(x["reward"]) >= 8))
    once = lambda held: F.filter(held, lambda x, i: F.array_position(held["spend_inr"], x["spend_inr"]) == i + 1)
    return let(let(found, once), some)


def lounge(md: Column, held: Column | None = None) -> Column:
    """Visits a year: a count a quarter is four times, one a half-year twice (domestic only)."""

    def whole(held: Column) -> Column:
        home = F.try_element_at(F.filter(held, lambda c: has(c, r"\d") & ~says(c, ABROAD)), F.lit(1))
        abroad = F.try_element_at(F.filter(held, lambda c: has(c, r"\d") & says(c, ABROAD)), F.lit(1))
        count = lambda c: first(c, r"(\d+)\b(?=.*\blounge)").try_cast("int")
        times = lambda c: F.when(says(c, QUARTER), 4).when(says(c, HALF), 2).otherwise(1)
        note = lambda c, half: F.when(says(c, QUARTER), F.concat(count(c), F.lit(" per quarter"))).when(says(c, HALF) & half, F.concat(count(c), F.lit(" per half-year")))
        return _struct(
            unlimited=_flag(F.exists(held, lambda c: says(c, ("unlimited",)))),
            domestic_visits_year=count(home) * times(home),
            domestic_visits_note=note(home, F.lit(True)),
            international_visits_year=count(abroad) * F.when(says(abroad, QUARTER), 4).otherwise(1),
            international_visits_note=note(abroad, F.lit(False)),
            program=first(md, r"\b(priority\s+pass|dreamfolks|lounge\s?key)\b"),
            spend_unlock_inr=_found(held, lambda c: rupees(behind(c, SPENT), False)),
            guest_allowed=_flag(says(md, GUEST)),
        )

    return let(_spoken(_cut(md, held), HOME), whole)


#: What is insured against: accidents, loss of a card, of a purchase, on a journey.
RISKS = ("air", "personal"), ("lost", "liability", "credit shield", "fraud"), ("purchase",), ("travel", "overseas", "baggage", "flight", "trip")


def insurance(md: Column, held: Column | None = None) -> Column:
    """Covers of 10,000 rupees or more."""

    def whole(held: Column) -> Column:
        air, lost, bought, travel = RISKS
        cover = lambda *classes: _found(_spoken(held, *classes), lambda c: let(rupees(behind(c, classes[0]), False), lambda x: F.when(x >= 10_000, x)))
        return _struct(
            air_accident_inr=cover(air, ("accident",)),
            lost_card_inr=cover(lost, ("card", "liability", "shield", "protection")),
            purchase_protection_inr=cover(bought, ("protection",)),
            travel_inr=cover(travel, ("insurance", "cover", "delay")),
        )

    return let(_spoken(_cut(md, held), tuple(w for risk in RISKS for w in risk)), whole)


#: Brands whose offers are looked for, in this order.
BRANDS = (
    "Swiggy", "Zomato", "Amazon", "Flipkart", "BookMyShow", "Myntra", "Ola", "Uber", "IRCTC", "MakeMyTrip", "Cleartrip",
    "Nykaa", "BigBasket", "Blinkit", "PhonePe", "Paytm", "Tata Neu", "Cred", "Cult.fit", "Lenskart", "Dominos",
    "Pizza Hut", "Starbucks", "Ajio", "Netmeds", "1mg", "Apollo", "Zepto", "PVR", "INOX",
)
OFFER = ("cashback", "cash back", "discount", "off.", "voucher", "free.")


def partner_offers(md: Column, held: Column | None = None) -> Column:
    """For each brand the first clause that names it and speaks of an offer."""

    def whole(held: Column) -> Column:
        said = lambda brand: F.try_element_at(F.filter(held, lambda c: F.contains(c["low"], F.lit(brand.lower()))), F.lit(1))["text"]
        named = F.array(*[F.struct(F.lit(b).alias("partner"), said(b).alias("said")) for b in BRANDS])
        told = F.transform(F.filter(named, lambda x: x["said"].isNotNull()), lambda x: F.struct(x["partner"], snippet(x["said"]).alias("benefit")))
        return F.filter(told, lambda x: F.length(x["benefit"]) >= 12)

    offers = F.filter(_cut(md, held), lambda c: has(c, "[%₹]") | says(c, OFFER))
    lowered = F.transform(offers, lambda c: F.struct(c.alias("text"), F.lower(c).alias("low")))
    return let(lowered, lambda held: F.when(F.size(held) > 0, let(whole(held), some)))


#: Kinds of perk, in this order.
PERK_KINDS = (
    "golf", "golf_simulator", "movie", "dining", "concierge", "spa", "hotel", "subscription", "railway_lounge", "roadside_assist", "annual_voucher", "forex_perk", "contactless", "virtual_card",
    "emi_conversion",
)
#: What must be said beside a kind's noun where the noun alone may be only talked of.
GIVEN, LOWERED = ("complimentary", "free.", "upgrade", "off.", "discount", "get.", "enjoy"), ("zero.", "no.", "nil.", "low", "reduced", "waive")
_NOUNS = {"subscription": ("subscription", "membership", "prime.", "streaming"), "dining": ("dining", "restaurant"), "forex_perk": ("forex", "foreign currency", "cross currency"), "emi_conversion": ("emi.", "emis.", "instalment", "installment")}
_BESIDE = {"movie": (*GIVEN, "ticket"), "hotel": GIVEN, "subscription": GIVEN, "forex_perk": LOWERED, "emi_conversion": (*LOWERED, "convert", "conversion", "instant")}


def _speaks_of(kind: str) -> Callable[[Column], Column]:
    """Whether a clause has all words of a kind's name, or its nouns, with what must stand beside them."""
    classes = [_NOUNS[kind]] if kind in _NOUNS else [(word,) for word in kind.split("_")]
    return lambda clause: says(clause, *classes, *([_BESIDE[kind]] if kind in _BESIDE else []))


def perks(md: Column, held: Column | None = None) -> Column:
    """For each kind the first clause that speaks of it."""
    nouns = tuple(dict.fromkeys(w for kind in PERK_KINDS for w in _NOUNS.get(kind, (kind.split("_")[-1],))))

    def whole(held: Column) -> Column:
        said = F.array(*[F.struct(F.lit(kind).alias("kind"), F.try_element_at(F.filter(held, _speaks_of(kind)), F.lit(1)).alias("said")) for kind in PERK_KINDS])
        return F.transform(F.filter(said, lambda x: x["said"].isNotNull()), lambda x: F.struct(x["kind"], snippet(x["said"], 220).alias("value")))

    return let(F.filter(_cut(md, held), lambda c: says(c, nouns)), lambda held: F.when(F.size(held) > 0, let(whole(held), some)))


def eligibility(md: Column, held: Column | None = None) -> Column:
    """Ages, the least plausible yearly income (monthly ones times twelve), kinds of work."""

    def whole(held: Column) -> Column:
        age = lambda word: _found(held, lambda c: first(behind(c, word), r"^\D{0,30}?\bage\b\D{0,10}(\d+)").try_cast("int"))
        yearly = lambda c: F.when(says(c, ("month",)) & ~says(c, ("annum", "annual", "year")), 12).otherwise(1)
        incomes = F.transform(_spoken(held, ("income", "itr.")), lambda c: rupees(behind(c, ("income", "itr.")), False) * yearly(c))
        return _struct(
            min_age=age(("min.", "minimum")),
            max_age=age(("max.", "maximum")),
            min_income_inr_year=F.array_min(F.filter(incomes, lambda y: y >= 50_000)),
            salaried=_flag(says(md, ("salaried.",))),
            self_employed=_flag(says(md, ("self employed", "business owner"))),
        )

    return let(_cut(md, held), whole)


def apply_url(md: Column) -> Column:
    """Target of the first link whose label begins with "apply"."""
    links = every(md, r"\[(apply[^\[\]]*\]\(https?:[^()\s]+)\)")
    return F.substring_index(F.try_element_at(links, F.lit(1)), "](", -1)


def highlights(md: Column, most: int = 50) -> Column:
    """Bullet lines that say something of worth, the first of equal ones, at most ``most``."""
    bullets = F.filter(F.split(md, r"\n"), lambda x: x.rlike(r"^\s*(?:[-*•]|\d{1,2}\.)\s"))
    worthy = F.filter(bullets, lambda x: has(x, _VALUE) | says(x, WORTH))
    lines = F.transform(worthy, lambda x: snippet(F.regexp_replace(x, r"^\s*\S+\s+", ""), 220))
    return let(F.slice(let(F.filter(lines, lambda x: F.length(x).between(8, 220)), distinct_lower), 1, most), some)


# ── identity ──────────────────────────────────────────────────────────────────────────────────────

#: Networks as written and as kept.
NETWORKS = {"american express": "Amex", "amex": "Amex", "visa": "Visa", "mastercard": "Mastercard", "rupay": "RuPay", "diners": "Diners"}


def network(text: Column) -> Column:
    found = F.lower(replace(first(text, r"\b(visa|mastercard|rupay|amex|american\s+express|diners)\b"), r"\s+", " "))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in NETWORKS.items() for x in kv]), found)


def category(md: Column, url: Column) -> Column:
    """What the text names, credit before debit, prepaid and forex; else what the path says."""
    path = (
        F.when(url.rlike("/debit-cards?"), "debit").when(F.contains(url, F.lit("/prepaid")), "prepaid")
        .when(url.rlike("/forex|/multi-currency"), "forex").when(url.rlike("/business|/corporate"), "business").otherwise("credit")
    )
    said = F.when(has(md, r"credit\s+card"), "credit").when(has(md, r"debit\s+card"), "debit").when(has(md, r"prepaid\s+card"), "prepaid").when(has(md, r"forex\s+card|multi.?currency\s+card"), "forex")
    return F.coalesce(said, path)


def segment(md: Column) -> Column:
    """From the first 60 % of the text, without link labels."""
    head = replace(F.substring(md, F.lit(1), F.floor(F.length(md) * 0.6).cast("int")), r"\[[^\]]{0,120}\]\([^)]*\)")
    return (
        F.when(has(head, r"(?:super|ultra).?premium"), "super-premium").when(has(head, r"\bpremium\b"), "premium").when(has(head, r"\bstudent\b"), "student")
        .when(has(head, r"secured\s+(?:credit\s+)?card|against\s+(?:fd|fixed\s+deposit)"), "secured").when(has(head, r"\bentry.?level\b|\bbasic\b"), "entry")
    )


#: Heading of a product: level two or three, plain or linked, with a product word in it.
_HEADING = r"^#{2,3}\s+\[?[^\]\n]{0,100}(?:credit|debit|prepaid|forex|card|miles|rupay)[^\n]*$"


def sections(pages: DataFrame) -> DataFrame:
    """Listing pages by product heading: (page columns, pos, section_name, markdown); fewer than two headings give none."""
    parts = F.split("markdown", rx(rf"(?={_HEADING})", "im"))
    rows = pages.withColumn("__parts", parts).where(F.size("__parts") > 2)
    rows = rows.select(*[c for c in pages.columns if c != "markdown"], F.posexplode("__parts").alias("pos", "markdown")).where(F.col("markdown").rlike(rx(rf"\A{_HEADING}", "im")))
    name = replace(first(F.col("markdown"), r"\A#{2,3}\s+([^\n]*)"), r"\[([^\]]*)\]\([^)]*\)", "$1")
    return rows.withColumn("section_name", F.trim(name)).where(~names.generic(F.col("section_name")))


def cards(pages: DataFrame) -> DataFrame:
    """One v1 record a product page, and one a section of a listing page; forced names pass as they are.

    ``pages``: source_url, issuer_id, issuer_name, is_listing, markdown, force_card_name, force_category,
    force_network, sha. Pages that mention no kind of product, or give no name, give no record.
    """
    single = pages.where(~F.coalesce("is_listing", F.lit(False)) | F.col("force_card_name").isNotNull()).withColumn("section_name", F.lit(None).cast("string")).withColumn("pos", F.lit(0))
    listed = sections(pages.where(F.coalesce("is_listing", F.lit(False)) & F.col("force_card_name").isNull()))
    rows = single.unionByName(listed.select(*single.columns))
    md, url, forced = F.col("markdown"), F.col("source_url"), F.col("force_card_name")
    chosen = names.choose(F.col("section_name"), names.page_name(md), names.url_name(url), url)
    name = F.coalesce(forced, F.when(has(md, r"(?:credit|debit|forex)\s+card|prepaid"), chosen))
    # a filter on an exploded name stays here: on a plain column it moves into the scan, where names would be made once more, by as few tasks as there are splits
    rows = rows.select("*", F.explode(F.array(name)).alias("card_name")).where(F.col("card_name").isNotNull()).withColumn("__clauses", clauses(md))
    held = F.col("__clauses")
    return rows.select(
        "source_url", "issuer_id", "issuer_name", "pos", "sha", "card_name",
        F.when(forced.isNotNull(), F.coalesce("force_category", category(F.lit(""), url))).otherwise(category(md, url)).alias("category"),
        F.coalesce("force_network", network(md), network(F.col("card_name"))).alias("network"),
        segment(md).alias("segment"),
        F.when(has(md, r"\bmetal\s+card\b"), "metal").alias("card_material"),
        fees(md, held).alias("fees"), rewards(md, F.col("issuer_id"), held).alias("rewards"), welcome(md, held).alias("welcome_benefit"),
        milestones(md, held).alias("milestones"), lounge(md, held).alias("lounge_access"), insurance(md, held).alias("insurance"),
        partner_offers(md, held).alias("partner_offers"), perks(md, held).alias("perks"), eligibility(md, held).alias("eligibility"),
        apply_url(md).alias("apply_url"), highlights(md).alias("highlights"),
    )


def dealt_cards(pages: DataFrame) -> DataFrame:
    """``cards`` of pages that are dealt to all cores first; for written pages, whose rows are counted from files."""
    return cards(spread(pages, "source_url"))


def with_ids(records: DataFrame, run_ts: str) -> DataFrame:
    """card_id, where there is none, from issuer and name, and the stamps of this run (a parameter, so that reruns agree)."""
    issuer = F.coalesce(filled(F.col("issuer_id")), slug(F.col("issuer_name")))
    made = F.concat_ws("__", issuer, slug(F.col("card_name")))
    rows = records.withColumn("card_id", F.coalesce(filled(F.col("card_id")), made) if "card_id" in records.columns else made)
    return rows.withColumn("last_scraped_at", F.lit(run_ts)).withColumn("first_seen_at", F.lit(run_ts)).withColumn("status", F.lit("active"))
