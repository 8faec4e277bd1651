"""Answers merged into records by policy."""

import json

import pytest

from tessera.operators import normalise as n

ANSWERS = {
    "full": {
        "currency": "miles", "unit_value_inr": 0.5, "base": {"units": 2, "per_inr": 100, "rate_pct": "1"},
        "category_rewards": {"Dining!": {"rate_pct": 5, "cap_period": "monthly", "zzz": 1}, "dining ": {"units": "x"}, "fuel": {"cap_inr": 100}, "moon": {"rate_pct": 9}, "upi": 3, "travel": {"units": 4, "cap_period": "weekly"}},
        "milestones": [{"spend_inr": 100000, "reward_units": 10, "period": "annual"}, {"spend_inr": 0}, {"value_inr": 5}, "x", None],
        "welcome": {"reward_units": 500, "value_inr": None, "within_days": 30},
        "partner_offers": [{"partner": "Swiggy One", "value_pct": 10, "cap_inr": "5"}, {"partner": "!!"}, {"value_pct": 3}],
    },
    "misnested": {"rewards": {"currency": "miles"}, "card_name": "Other", "milestones": {"spend_inr": 1}, "welcome": [1], "category_rewards": ["dining"], "base": 3, "currency": 7, "partner_offers": "x"},
    "none": None, "broken": "{", "list": [], "empty": {},
}


@pytest.fixture(scope="module")
def cards(spark):
    rows = [(k, "A", "N", {"currency": None, "base_rate_pct": None}, [{"spend_inr": 7.0, "period": "annual"}], [f"h{i}" for i in range(50)], 9) for k in (*ANSWERS, "unasked")]
    rows += [("own", "A", "N", {"currency": "cashback", "base_rate_pct": 2.0}, None, ["h"], 9), ("silent", "A", "N", None, None, [], 9), ("nohl", "A", "N", None, None, None, 9)]
    return spark.createDataFrame(rows, "card_id string, issuer_id string, card_name string, rewards struct<currency:string,base_rate_pct:double>, milestones array<struct<spend_inr:double,period:string>>, highlights array<string>, __v int").drop("__v")


def asked(spark):
    said = {**ANSWERS, "own": ANSWERS["full"]}
    rows = [(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in said.items()]
    return lambda prompts: prompts.join(spark.createDataFrame(rows, "card_id string, answer string"), "card_id", "left")


def test_merge(spark, cards):
    once = n.normalise(cards, asked(spark))
    got = {r.card_id: r for r in once.collect()}
    full = got["full"]
    assert (full.rewards.currency, full.rewards.unit_value_inr, full.rewards.base_units, full.rewards.base_per_inr, full.rewards.base_rate_pct) == ("miles", 0.5, 2.0, 100.0, None)
    kept = {k: {x: y for x, y in v.asDict().items() if y is not None} for k, v in full.rewards.category_rewards.items()}
    assert kept == {"dining": {"rate_pct": 5.0, "cap_period": "monthly"}, "travel": {"units": 4.0}}
    assert [(m.spend_inr, m.reward_units, m.period) for m in full.milestones] == [(100000.0, 10.0, "annual")]
    assert (full.welcome_benefit.reward_units, full.welcome_benefit.within_days) == (500.0, None)
    assert [(o.partner, o.value_pct, o.cap_inr) for o in full.partner_offers] == [("swiggyone", 10.0, None)] and full.normalised
    for k in ("misnested", "broken", "list", "empty"):
        r = got[k]
        assert r.normalised and r.card_name == "N" and r.rewards.currency is None and [m.spend_inr for m in r.milestones] == [7.0] and r.welcome_benefit is None and r.partner_offers is None, k
    assert not got["none"].normalised and not got["unasked"].normalised and not got["silent"].normalised
    assert got["own"].rewards.currency == "cashback" and got["own"].rewards.base_rate_pct == 2.0 and got["own"].rewards.base_units == 2.0
    assert got["silent"].rewards is None and len(got) == cards.count()


def test_again_changes_nothing(spark, cards):
    kept = n.normalise(cards, asked(spark))
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    assert {r.card_id for r in n.waiting(kept).collect()} == {"none", "unasked"}
    again = n.apply_answers(kept, asked(spark)(n.requests(cards)).select("card_id", "answer"))
    held = lambda df: {r.card_id: r.asDict(True) for r in df.select(*kept.columns).collect()}
    assert held(again) == held(kept)


def test_requests(spark, cards):
    got = {r.card_id: r.prompt for r in n.requests(n.waiting(cards, ["full", "silent", "nohl"])).collect()}
    assert set(got) == {"full"} and got["full"].startswith("CARD: N\nBULLETS:\n- h0\n- h1\n") and got["full"].endswith("- h39")
