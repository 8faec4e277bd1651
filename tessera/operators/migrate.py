"""From extracted (v1) to published (v2) records, and the published schema's checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.functions import json_schema
from tessera.functions.text import first, let, slug
from tessera.operators.card_schema import CARD
from tessera.operators.extract import _struct, some

#: Enumerations of the published schema and the spellings that lead to them.
CATEGORIES = ("credit", "debit", "prepaid", "forex", "corporate", "business")
SEGMENTS = ("entry", "mid", "premium", "super_premium", "invite_only", "student", "secured", "nri")
MATERIALS = ("metal", "plastic", "virtual")
NETWORK_KEYS = {"visa": "visa", "mastercard": "mastercard", "rupay": "rupay", "amex": "amex", "american_express": "amex", "diners": "diners", "diners_club": "diners"}
PERIODS = ("monthly", "quarterly", "half_yearly", "annual", "anniversary")
PERK_KINDS = {
    "golf": "golf", "golf_simulator": "golf", "movie": "movie", "dining": "dining", "concierge": "concierge", "spa": "spa",
    "hotel": "hotel", "subscription": "subscription", "railway_lounge": "railway_lounge", "roadside_assist": "roadside_assist",
    "annual_voucher": "voucher", "forex_perk": "forex_perk", "contactless": "contactless", "virtual_card": "virtual_card",
    "emi_conversion": "emi_conversion",
}
CURRENCY_KEYS = {
    "reward_point": "reward_points", "reward_points": "reward_points", "point": "reward_points", "points": "reward_points",
    "cashback": "cashback", "cash_back": "cashback", "cashpoints": "cashpoints", "neucoins": "neucoins", "neucoin": "neucoins",
    "edge_miles": "edge_miles", "indusmiles": "indusmiles", "kotak_points": "kotak_points",
    "membership_rewards": "membership_rewards", "miles": "miles", "skywards_miles": "skywards_miles", "inr": "cashback",
}


def look_up(value: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)


def one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    return F.when(value.isin(*allowed), value)


def token(value: Column) -> Column:
    return slug(value, "_", None)


def to_v2(cards: DataFrame) -> DataFrame:
    """Published records: fields renamed, texts canonicalised or dropped, empty structs and arrays null."""
    fees, rewards, lounge, cover, who = (F.col(c) for c in ("fees", "rewards", "lounge_access", "insurance", "eligibility"))
    program = token(lounge["program"])
    periods = F.transform(F.filter("milestones", lambda m: m["spend_inr"].isNotNull()), lambda m: F.struct(m["spend_inr"].alias("spend_inr"), one_of(m["period"], PERIODS).alias("period")))
    kinds = F.array_distinct(F.filter(F.transform("perks", lambda p: look_up(p["kind"], PERK_KINDS)), lambda k: k.isNotNull()))
    brands = F.array_distinct(F.filter(F.transform("partner_offers", lambda o: token(o["partner"])), lambda t: t.isNotNull()))
    return cards.select(
        *[c for c in ("card_id", "issuer_id", "issuer_name", "card_name", "source_url", "apply_url", "sha", "last_scraped_at", "first_seen_at") if c in cards.columns],
        F.coalesce(one_of(F.col("category"), CATEGORIES), F.lit("credit")).alias("category"),
        F.coalesce("status", F.lit("active")).alias("status"),
        look_up(token(F.col("network")), NETWORK_KEYS).alias("network"),
        one_of(token(F.col("card_material")), MATERIALS).alias("card_material"),
        one_of(F.translate("segment", "-", "_"), SEGMENTS).alias("segment"),
        _struct(
            joining_inr=fees["joining_fee_inr"], annual_inr=fees["annual_fee_inr"], renewal_inr=fees["renewal_fee_inr"],
            waiver_spend_inr=fees["fee_waiver_spend_inr"], addon_inr=fees["addon_card_fee_inr"], fx_markup_pct=fees["fx_markup_pct"],
            cash_advance_pct=fees["cash_advance_fee_pct"], finance_charge_pct_mo=fees["finance_charge_pct_mo"],
            fuel_surcharge_waiver_pct=first(fees["fuel_surcharge_waiver"], r"(\d+(?:\.\d+)?)\s*%").try_cast("double"), gst_extra=fees["gst_extra"],
        ).alias("fees"),
        _struct(
            currency=look_up(token(rewards["currency"]), CURRENCY_KEYS), unit_value_inr=rewards["point_value_inr"],
            base_rate_pct=rewards["base_rate_pct"], expiry_months=rewards["expiry_months"],
        ).alias("rewards"),
        _struct(
            domestic_year=lounge["domestic_visits_year"], international_year=lounge["international_visits_year"],
            unlimited_domestic=F.when(lounge["unlimited"], True), guest_allowed=lounge["guest_allowed"],
            program=F.when(program.contains("priority"), "priority_pass").when(program.contains("dreamfolks"), "dreamfolks").when(program.rlike("lounge_?key"), "loungekey"),
            spend_unlock_inr=lounge["spend_unlock_inr"],
        ).alias("lounge_access"),
        _struct(
            air_accident_inr=cover["air_accident_inr"], lost_card_liability_inr=cover["lost_card_inr"],
            purchase_protection_inr=cover["purchase_protection_inr"], travel_inr=cover["travel_inr"],
        ).alias("insurance"),
        _struct(**{f: who[f] for f in ("min_age", "max_age", "min_income_inr_year", "salaried", "self_employed")}).alias("eligibility"),
        let(periods, some).alias("milestones"),
        let(F.transform(kinds, lambda k: F.struct(k.alias("kind"))), some).alias("perks"),
        let(F.transform(brands, lambda b: F.struct(b.alias("partner"))), some).alias("partner_offers"),
        "highlights",
    )


#: Columns of a record that the published document has under another name, or not at all.
_RENAMED = {"sha": "raw_text_sha256"}


def errors(cards: DataFrame) -> Column:
    """The published schema's checks that a v2 record fails, sorted; an empty array if it is valid.

    The record is checked as the document it is published as, in which fields without a value are left out.
    """
    of = StructType([StructField(_RENAMED.get(f.name, f.name), f.dataType) for f in cards.schema.fields])
    record = F.struct(*[F.col(c).alias(_RENAMED.get(c, c)) for c in cards.columns])
    return let(record, lambda r: json_schema.record_errors(r, of, CARD))


def validated(cards: DataFrame) -> DataFrame:
    return cards.withColumn("errors", errors(cards))
