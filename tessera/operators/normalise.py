"""Highlights normalised by a provider's answers: what to ask, how an answer is read, how it is merged into records.

Answers are VARIANT documents read by type, field by field, so a number in quotes, a misplaced object or an unknown
name is left out and spoils nothing else. The merge is compiled by walking the record's StructType with a policy
for paths: fill a gap, replace a value as a whole, or (no policy) keep the record's own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructType

from tessera.functions.json_schema import elements, kind, members
from tessera.functions.text import let
from tessera.operators.card_schema import CATEGORY_KEYS, RECORD
from tessera.operators.enrich import has_data

MOST_HIGHLIGHTS = 40
#: Periods that an answer may name.
PERIODS = ("daily", "monthly", "quarterly", "half_yearly", "annual", "anniversary", "statement", "per_transaction")


@dataclass(frozen=True)
class Take:
    """How a value is read from an answer.

    ``at``: its path there. ``only``: the fields that are read of an object or of a list's or map's entries, with their own rules.
    ``allowed``: texts that count, others are null. ``spelled``: a text's cleaning. ``keys``: a map's names, spelled first.
    ``needs``: an entry counts if one of these fields is there. ``nonzero``: zero counts as nothing.
    """

    at: str = ""
    replace: bool = False
    only: dict[str, "Take"] = field(default_factory=dict)
    allowed: tuple[str, ...] = ()
    spelled: Callable[[Column], Column] | None = None
    keys: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    nonzero: bool = False


def letters(text: Column, more: str = "") -> Column:
    """Lower case, and nothing but letters, underscores and ``more``."""
    return F.regexp_replace(F.lower(text), f"[^a-z_{more}]", "")


_ANY, _PERIOD = Take(), Take(allowed=PERIODS)
POLICY: dict[str, Take] = {
    "rewards.currency": Take("currency"),
    "rewards.unit_value_inr": Take("unit_value_inr"),
    "rewards.base_units": Take("base.units"),
    "rewards.base_per_inr": Take("base.per_inr"),
    "rewards.base_rate_pct": Take("base.rate_pct"),
    "rewards.category_rewards": Take(
        "category_rewards", replace=True, keys=CATEGORY_KEYS, spelled=letters, needs=("rate_pct", "units"),
        only={"rate_pct": _ANY, "units": _ANY, "per_inr": _ANY, "cap_inr": _ANY, "cap_period": _PERIOD},
    ),
    "milestones": Take("milestones", replace=True, needs=("spend_inr",), only={"spend_inr": Take(nonzero=True), "reward_units": _ANY, "value_inr": _ANY, "period": _PERIOD}),
    "welcome_benefit": Take("welcome", replace=True, only={"reward_units": _ANY, "value_inr": _ANY, "min_spend_inr": _ANY}),
    "partner_offers": Take("partner_offers", replace=True, needs=("partner",), only={"partner": Take(spelled=lambda x: letters(x, "0-9")), "value_pct": _ANY, "cap_inr": _ANY}),
}


def member(held: Column, path: str) -> Column:
    """The value at a dotted path of objects, from the members of the outermost; null where a step is no object or has no such member."""
    first, *more = path.split(".")
    value = F.try_element_at(held, F.lit(first))
    for name in more:
        value = F.try_element_at(members(value), F.lit(name))
    return value


def read(value: Column, of: DataType, take: Take) -> Column:
    """A VARIANT value as ``of``; null for a value of another kind. Entries that lack what they need are left out."""
    if isinstance(of, StructType):
        def fields(held: Column) -> Column:
            return F.struct(*[
                (read(F.try_element_at(held, F.lit(f.name)), f.dataType, take.only[f.name]) if f.name in take.only else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in of.fields
            ])

        return let(members(value), lambda held: F.when(held.isNotNull(), fields(held)))
    if isinstance(of, ArrayType):
        return F.filter(F.transform(elements(value), lambda x: read(x, of.elementType, take)), lambda x: _enough(x, take))
    if isinstance(of, MapType):
        clean = take.spelled or (lambda x: x)
        entries = F.transform(F.map_entries(members(value)), lambda e: F.struct(clean(e["key"]).alias("key"), read(e["value"], of.valueType, take).alias("value")))

        def named(held: Column) -> Column:
            """Of two spellings of one name the later counts; a variant has its names in order."""
            found = F.transform(F.array(*[F.lit(k) for k in take.keys]), lambda k: F.try_element_at(F.filter(held, lambda e: e["key"] == k), F.lit(-1)))
            return F.map_from_entries(F.filter(found, lambda e: e.isNotNull()))

        return let(F.filter(entries, lambda e: _enough(e["value"], take)), named)
    if isinstance(of, StringType):
        text = let(value, lambda v: F.when(kind(v) == "string", F.try_variant_get(v, "$", "string")))
        text = take.spelled(text) if take.spelled else text
        return let(text, lambda t: F.when(t.isin(*take.allowed) if take.allowed else t != "", t))
    if isinstance(of, BooleanType):
        return let(value, lambda v: F.when(kind(v) == "boolean", F.try_variant_get(v, "$", "boolean")))
    if isinstance(of, (DoubleType, LongType)):
        number = let(value, lambda v: F.when(kind(v).isin("integer", "number"), F.try_variant_get(v, "$", of.simpleString())))
        return let(number, lambda n: F.when(n != 0, n)) if take.nonzero else number
    raise TypeError(f"no rule reads {of.simpleString()}")


def _enough(entry: Column, take: Take) -> Column:
    there = F.lit(not take.needs)
    for name in take.needs:
        there = there | entry[name].isNotNull()
    return entry.isNotNull() & there


def _says(value: Column, of: DataType) -> Column:
    return F.coalesce(F.size(value) > 0, F.lit(False)) if isinstance(of, MapType) else has_data(value, of)


def merged(base: Column, answer: Column, of: DataType, policy: dict[str, Take], path: str = "") -> Column:
    """``base`` with what the policy takes from the members of the answer, compiled by walking the type."""
    if path in policy:
        take = policy[path]
        new = read(member(answer, take.at), of, take)
        return let(new, lambda new: F.when(_says(new, of) & (F.lit(take.replace) | ~_says(base, of)), new).otherwise(base))
    if isinstance(of, StructType) and any(p.startswith(f"{path}." if path else "") for p in policy):
        parts = F.struct(*[merged(base[f.name], answer, f.dataType, policy, f"{path}.{f.name}" if path else f.name).alias(f.name) for f in of.fields])
        # a record that has no such part gets one only if the answer fills some of it
        return let(parts, lambda parts: F.when(base.isNotNull() | has_any(parts, of), parts))
    return base


def has_any(value: Column, of: StructType) -> Column:
    out = F.lit(False)
    for f in of.fields:
        out = out | _says(value[f.name], f.dataType)
    return out


def conformed(value: Column, now: DataType, wanted: DataType) -> Column:
    """A value of one nested type as another: fields by name, missing ones null, further ones gone, numbers cast."""
    if isinstance(wanted, StructType) and isinstance(now, StructType):
        held = {f.name: f.dataType for f in now.fields}
        parts = [(conformed(value[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, ArrayType) and isinstance(now, ArrayType):
        return F.transform(value, lambda x: conformed(x, now.elementType, wanted.elementType))
    if isinstance(wanted, MapType) and isinstance(now, MapType):
        return F.transform_values(value, lambda _, x: conformed(x, now.valueType, wanted.valueType))
    return value if now == wanted else value.cast(wanted)


def as_records(cards: DataFrame) -> DataFrame:
    """Records with all fields of the published type; other columns stay as they are behind them."""
    held = {f.name: f.dataType for f in cards.schema.fields}
    parts = [(conformed(F.col(f.name), held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in RECORD.fields]
    return cards.select(*parts, *[c for c in cards.columns if c not in RECORD.names])


def waiting(cards: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Records with highlights that have not been normalised, of the given ids if any."""
    done = F.coalesce(F.col("normalised"), F.lit(False)) if "normalised" in cards.columns else F.lit(False)
    rows = cards.where((F.size("highlights") > 0) & ~done)
    return rows.where(F.col("card_id").isin(only)) if only else rows


def requests(cards: DataFrame) -> DataFrame:
    """(card_id, prompt): a record's name and its first highlights as bullets."""
    bullets = F.transform(F.slice("highlights", 1, MOST_HIGHLIGHTS), lambda h: F.concat(F.lit("- "), h))
    return cards.select("card_id", F.concat(F.lit("CARD: "), F.coalesce("card_name", F.lit("")), F.lit("\nBULLETS:\n"), F.array_join(bullets, "\n")).alias("prompt"))


def apply_answers(cards: DataFrame, answers: DataFrame) -> DataFrame:
    """Records with the answers (card_id, answer: JSON text) merged in and ``normalised`` set.

    A record without an answer, or with a null one (the provider failed), stays waiting; an answer that is no JSON
    object changes nothing and is not asked for again. Applying the same answers again changes nothing. An id that
    was answered twice takes the answer that sorts last.
    """
    rows = as_records(cards)
    own = F.coalesce(F.col("normalised"), F.lit(False)) if "normalised" in rows.columns else F.lit(False)
    one = answers.where("answer is not null").groupBy("card_id").agg(F.max("answer").alias("__answer"))
    rows = rows.withColumn("normalised", own).join(one, "card_id", "left").withColumn("__m", members(F.try_parse_json("__answer")))
    tops = {p.split(".")[0] for p in POLICY}
    value = {f.name: merged(F.col(f.name), F.col("__m"), f.dataType, POLICY, f.name).alias(f.name) if f.name in tops else F.col(f.name) for f in RECORD.fields}
    others = [c for c in rows.columns if c not in value and c not in ("__answer", "__m", "normalised")]
    return rows.select(*value.values(), *others, (F.col("normalised") | F.col("__answer").isNotNull()).alias("normalised"))


def normalise(cards: DataFrame, ask: Callable[[DataFrame], DataFrame], only: list[str] | None = None) -> DataFrame:
    """All records, those that waited asked about and merged. ``ask``: (card_id, prompt) to (card_id, answer)."""
    return apply_answers(cards, ask(requests(waiting(cards, only))).select("card_id", "answer"))
