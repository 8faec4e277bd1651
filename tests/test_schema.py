"""The compiled schema against a plain validator, on records that are mutated in every way it tells of."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions import json_schema
from tessera.operators.card_schema import CARD, RECORD

GOOD = {
    "card_id": "a__b", "issuer_id": "a", "card_name": "B", "category": "credit", "source_url": "u", "network": None, "segment": "mid",
    "fees": {"annual_inr": 500, "fx_markup_pct": 3.5, "gst_extra": True},
    "rewards": {"currency": "miles", "expiry_months": 24.0, "category_rewards": {"dining": {"rate_pct": 5, "cap_period": "monthly"}}, "accelerated": [{"units": 2}], "exclusions": ["fuel", "rent"]},
    "milestones": [{"spend_inr": 1e5, "period": "annual"}, {"spend_inr": 2}], "perks": [{"kind": "golf", "brand": None}], "partner_offers": [],
    "eligibility": {"min_age": 21}, "highlights": ["x"], "confidence": 0.5, "more": {"any": [1]},
}


def plain(value, schema, path=""):
    """The rules one after another on Python values."""
    while "$ref" in schema:
        schema = CARD["$defs"][schema["$ref"].rsplit("/", 1)[-1]]
    here, out = path or "document", []
    is_ = {
        "object": isinstance(value, dict), "array": isinstance(value, list), "string": isinstance(value, str), "null": value is None, "boolean": isinstance(value, bool),
        "number": isinstance(value, (int, float)) and not isinstance(value, bool), "integer": isinstance(value, (int, float)) and not isinstance(value, bool) and value % 1 == 0,
    }
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_[k] for k in kinds):
        out.append(f"{here}: type")
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{here}: not allowed")
    if is_["number"]:
        out += [f"{here}: {w}" for w, bad in (("minimum", lambda x: value < x), ("maximum", lambda x: value > x)) if w in schema and bad(schema[w])]
    dot = f"{path}." if path else ""
    if is_["object"]:
        known = schema.get("properties", {})
        out += [f"{dot}{k}: required" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            more = schema.get("additionalProperties", True)
            if k in known:
                out += plain(v, known[k], dot + k)
            elif more is False:
                out.append(f"{dot}{k}: not expected")
            elif isinstance(more, dict):
                out += plain(v, more, dot + k)
            if k not in schema.get("propertyNames", {"enum": value})["enum"]:
                out.append(f"{dot}{k}: name not allowed")
    if is_["array"] and "items" in schema:
        for i, v in enumerate(value):
            out += plain(v, schema["items"], f"{path}[{i}]")
    return sorted(out)


def places(value, at=()):
    yield at
    for k, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        yield from places(v, (*at, k))


def mutated(rnd):
    doc = copy.deepcopy(GOOD)
    for _ in range(rnd.randint(0, 3)):
        at = rnd.choice([x for x in places(doc) if x])
        holder = doc
        for k in at[:-1]:
            holder = holder[k]
        what = rnd.random()
        if what < 0.2:
            del holder[at[-1]]
        elif what < 0.35 and isinstance(holder, dict):
            holder[rnd.choice(["zzz", "spend_inr", "kind", "dining"])] = rnd.choice([1, {}, "x"])
        else:
            holder[at[-1]] = rnd.choice([None, True, 7, -2.5, 1.5, "7", "credit", [], ["fuel", 3], {}, {"rate_pct": "x", "q": 1}, [{"kind": "golf"}, {}, None]])
    return doc


def test_same_errors_as_the_plain_validator(spark):
    rnd = random.Random(5)
    docs = [GOOD, {}, [], "x", 3, None] + [mutated(rnd) for _ in range(400)]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string")
    got = {r.i: r.e for r in rows.select("i", json_schema.errors(F.parse_json("j"), CARD).alias("e")).collect()}
    want = {i: plain(d, CARD) for i, d in enumerate(docs)}
    assert got == want and sum(map(len, want.values())) > 200 and want[0] == []


def test_no_document_gives_no_errors_and_unknown_rules_raise(spark):
    rows = spark.createDataFrame([("{",), (None,)], "j string")
    assert [r.e for r in rows.select(json_schema.errors(F.try_parse_json("j"), CARD).alias("e")).collect()] == [None, None]
    with pytest.raises(ValueError):
        json_schema.errors(F.lit(None), {"type": "string", "pattern": "x"})


def test_record_type(spark):
    assert RECORD["rewards"].dataType["category_rewards"].dataType.simpleString().startswith("map<string,struct<category:string,units:double")
    assert RECORD["milestones"].dataType.elementType["spend_inr"].dataType.simpleString() == "double"


def test_typed_records_have_the_errors_of_their_documents(spark):
    rnd = random.Random(6)
    docs = [GOOD, {}] + [x for x in (mutated(rnd) for _ in range(300)) if isinstance(x, dict)]
    more = StructType([*RECORD.fields, StructField("more", StringType())])
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string").select("i", F.from_json("j", more).alias("r"))
    got = rows.select("i", F.to_json("r", {"ignoreNullFields": "true"}).alias("j"), json_schema.record_errors(F.col("r"), more, CARD).alias("e")).collect()
    want = {r.i: plain(json.loads(r.j), CARD) for r in got if r.j}
    assert {r.i: r.e for r in got if r.j} == want and sum(map(len, want.values())) > 100


def test_types_that_do_not_fit_are_told(spark):
    of = StructType.fromDDL("card_id int, issuer_id string, card_name string, category string, source_url string, fees struct<annual_inr:string,odd:int>, eligibility struct<min_age:double>, confidence float, milestones array<struct<spend_inr:double>>")
    r = spark.createDataFrame([((7, "a", "b", "credit", None, ("5", 1), (1.5,), 1.5, [None, (None,), (2.0,)]),)], StructType([StructField("r", of)]))
    assert r.select(json_schema.record_errors(F.col("r"), of, CARD).alias("e")).first().e == [
        "card_id: type", "confidence: maximum", "eligibility.min_age: type", "fees.annual_inr: type", "fees.odd: not expected", "milestones[0]: type", "milestones[1].spend_inr: required", "source_url: required",
    ]
