"""The published schema of records, stated once: documents are checked by it and the record type is made of it."""

from __future__ import annotations

from tessera.functions.json_schema import Schema, struct_of

NUMBER, INTEGER, BOOLEAN, TEXT = ({"type": [x, "null"]} for x in ("number", "integer", "boolean", "string"))


def choice(*names: str) -> Schema:
    """One of the names, or null."""
    return {"type": ["string", "null"], "enum": [None, *names]}


def must(*names: str) -> Schema:
    return {"type": "string", "enum": list(names)} if names else {"type": "string"}


def record(required: tuple[str, ...] = (), **fields: Schema) -> Schema:
    return {"type": "object", "additionalProperties": False, "required": list(required), "properties": fields}


def listed(items: Schema) -> Schema:
    return {"type": "array", "items": items}


#: The names of the published schema, its enumerations and bounds.
CATEGORY_KEYS = (
    "dining", "swiggy", "zomato", "food_delivery", "fuel", "grocery", "online_shopping", "amazon", "flipkart", "myntra", "flights",
    "hotels", "travel", "international", "utilities", "bill_payments", "upi", "movies", "entertainment", "insurance", "rent",
    "education", "wallet_load", "departmental_store", "smartbuy_portal", "wallet", "gaming",
)
CARD: Schema = {
    "type": "object",
    "required": ["card_id", "issuer_id", "card_name", "category", "source_url"],
    "$defs": {
        "rate": record(
            category=TEXT, units=NUMBER, per_inr=NUMBER, multiplier=NUMBER, rate_pct=NUMBER, cap_inr=NUMBER, cap_units=NUMBER,
            cap_period=choice("daily", "monthly", "quarterly", "annual", "statement", "per_transaction"),
            channel=choice("upi", "card_swipe", "online", "offline", "app", "international"),
        ),
    },
    "properties": {
        "card_id": must(), "issuer_id": must(), "issuer_name": TEXT, "card_name": must(), "co_brand": TEXT,
        "card_material": choice("metal", "plastic", "virtual"),
        "network": choice("visa", "mastercard", "rupay", "amex", "diners"),
        "category": must("credit", "debit", "prepaid", "forex", "corporate", "business"),
        "segment": choice("entry", "mid", "premium", "super_premium", "invite_only", "student", "secured", "nri"),
        "status": must("active", "discontinued", "upcoming", "invite_only", "unknown"),
        "fees": record(
            joining_inr=NUMBER, annual_inr=NUMBER, renewal_inr=NUMBER, waiver_spend_inr=NUMBER, lifetime_free=BOOLEAN, addon_inr=NUMBER,
            fx_markup_pct=NUMBER, cash_advance_pct=NUMBER, finance_charge_pct_mo=NUMBER, redemption_fee_inr=NUMBER,
            fuel_surcharge_waiver_pct=NUMBER, fuel_waiver_cap_inr=NUMBER, gst_extra=BOOLEAN,
        ),
        "rewards": record(
            currency=TEXT, unit_value_inr=NUMBER, base_units=NUMBER, base_per_inr=NUMBER, base_rate_pct=NUMBER, is_cashback=BOOLEAN,
            expiry_months=INTEGER, monthly_cap_inr=NUMBER,
            category_rewards={"type": "object", "additionalProperties": {"$ref": "#/$defs/rate"}, "propertyNames": {"enum": list(CATEGORY_KEYS)}},
            accelerated=listed({"$ref": "#/$defs/rate"}),
            redemption_modes=listed(must(
                "statement_credit", "cashback", "flights", "hotels", "vouchers", "gift_cards", "merchandise", "smartbuy", "amazon_pay",
                "airmiles", "charity", "fuel", "bill_pay",
            )),
            transfer_partners=listed(must()),
            exclusions=listed(must("fuel", "rent", "wallet", "utilities", "insurance", "education", "government", "ewallet", "emi", "cash")),
        ),
        "partner_offers": listed(record(
            ("partner",), partner=must(), offer_type=choice("cashback", "discount", "voucher", "membership", "bogo", "free_delivery"),
            value_pct=NUMBER, value_inr=NUMBER, cap_inr=NUMBER, min_spend_inr=NUMBER,
            frequency=choice("per_transaction", "daily", "monthly", "quarterly", "annual"),
        )),
        "milestones": listed(record(
            ("spend_inr",), spend_inr={"type": "number"}, period=choice("monthly", "quarterly", "half_yearly", "annual", "anniversary"),
            reward_type=choice("points", "miles", "cashback", "voucher", "gift_card", "membership", "fee_waiver", "lounge", "flight_ticket"),
            reward_units=NUMBER, value_inr=NUMBER, incremental=BOOLEAN,
        )),
        "welcome_benefit": record(
            reward_type=choice("points", "miles", "cashback", "voucher", "gift_card", "membership", "fee_waiver"),
            reward_units=NUMBER, value_inr=NUMBER, min_spend_inr=NUMBER, within_days=INTEGER,
        ),
        "lounge_access": record(
            domestic_year=INTEGER, international_year=INTEGER, unlimited_domestic=BOOLEAN, unlimited_international=BOOLEAN,
            railway_year=INTEGER, guest_allowed=BOOLEAN, program=choice("priority_pass", "dreamfolks", "loungekey", "own_network"),
            spend_unlock_inr=NUMBER,
        ),
        "insurance": record(
            air_accident_inr=NUMBER, personal_accident_inr=NUMBER, lost_card_liability_inr=NUMBER, purchase_protection_inr=NUMBER,
            travel_inr=NUMBER, baggage_loss_inr=NUMBER, flight_delay_inr=NUMBER, credit_shield_inr=NUMBER,
        ),
        "emi": record(no_cost_emi=BOOLEAN, interest_free_days=INTEGER, min_txn_inr=NUMBER, processing_fee_pct=NUMBER),
        "forex": record(markup_pct=NUMBER, zero_markup=BOOLEAN, multi_currency=BOOLEAN, supported_currencies=INTEGER),
        "perks": listed(record(
            ("kind",),
            kind=must(
                "golf", "movie", "dining", "spa", "concierge", "hotel", "subscription", "voucher", "gift_card", "railway_lounge",
                "roadside_assist", "contactless", "virtual_card", "emi_conversion", "forex_perk", "buy_one_get_one", "fuel_benefit",
                "wellness", "insurance", "other",
            ),
            brand=TEXT, value_inr=NUMBER, count_year=INTEGER, cap_inr=NUMBER,
        )),
        "eligibility": record(
            min_age=INTEGER, max_age=INTEGER, min_income_inr_year=NUMBER, min_income_inr_month=NUMBER, min_credit_score=INTEGER,
            salaried=BOOLEAN, self_employed=BOOLEAN, secured_against_fd=BOOLEAN,
        ),
        "highlights": listed(must()), "apply_url": TEXT, "image_url": TEXT, "source_url": must(), "raw_text_sha256": TEXT,
        "last_scraped_at": TEXT, "first_seen_at": TEXT, "confidence": {"type": ["number", "null"], "minimum": 0, "maximum": 1},
    },
}
RECORD = struct_of(CARD)
