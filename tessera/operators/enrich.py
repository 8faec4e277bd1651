"""Filling gaps of rule-made records from a second source (a language model's answers, or any other)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from tessera.operators.names import clean, grounded

#: The detail fields that may be filled, and strings that say nothing.
DETAILS = (
    "fees", "rewards", "lounge_access", "insurance", "milestones", "perks", "partner_offers", "eligibility",
    "welcome_benefit", "network", "segment", "apply_url", "card_material",
)
SAYS_NOTHING = ("", "null", "none", "n/a")
TEXT_LIMIT = 9000


def has_data(value: Column, kind: DataType) -> Column:
    """Whether a value says anything; structs and arrays do if any part of them does; zero and false do."""
    if isinstance(kind, StructType):
        parts = F.lit(False)
        for field in kind.fields:
            parts = parts | has_data(value[field.name], field.dataType)
        return F.coalesce(value.isNotNull() & parts, F.lit(False))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(value, lambda x: has_data(x, kind.elementType)), F.lit(False))
    if isinstance(kind, StringType):
        return F.coalesce(~F.lower(F.trim(value)).isin(*SAYS_NOTHING), F.lit(False))
    return value.isNotNull()


def fill(base: Column, extra: Column, kind: DataType) -> Column:
    """``base`` where it says something, else ``extra``; of two structs field by field."""
    if isinstance(kind, StructType):
        parts = F.struct(*[fill(base[f.name], extra[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(has_data(base, kind), F.when(has_data(extra, kind), parts).otherwise(base)).when(has_data(extra, kind), extra)
    return F.when(has_data(base, kind), base).when(has_data(extra, kind), extra).otherwise(base)


def fill_records(base: DataFrame, extra: DataFrame, on: str, fields: tuple[str, ...] = DETAILS) -> DataFrame:
    """Records of ``base`` with empty detail fields filled from the ``extra`` record of the same key."""
    kinds = {f.name: f.dataType for f in base.schema.fields}
    use = [f for f in fields if f in kinds and f in extra.columns]
    renamed = extra.select(on, *[F.col(f).alias(f"__{f}") for f in use], F.lit(True).alias("__there"))
    rows = base.join(renamed, on, "left")
    for f in use:
        rows = rows.withColumn(f, F.when(F.col("__there"), fill(F.col(f), F.col(f"__{f}"), kinds[f])).otherwise(F.col(f)))
    return rows.drop("__there", *[f"__{f}" for f in use])


def prompts(pages: DataFrame) -> DataFrame:
    """(source_url, prompt): a header and the text, cut to what a model is given."""
    header = F.format_string("SOURCE: %s\nISSUER: %s\n\n", F.col("source_url"), F.coalesce("issuer_name", F.lit("unknown")))
    return pages.select("source_url", F.concat(header, F.substring("markdown", 1, TEXT_LIMIT)).alias("prompt"))


def ask(prompted: DataFrame, provider: Callable[[list[str]], list[str | None]]) -> DataFrame:
    """Adds ``answer`` (null: ask again later), a batch of prompts at a time. The provider is any picklable function."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            answers = pa.array(provider(batch["prompt"].to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, answers], names=[*batch.schema.names, "answer"])

    return prompted.mapInArrow(run, StructType([*prompted.schema.fields]).add("answer", "string"))


def parsed(answers: DataFrame, schema: str, answer: str = "answer") -> DataFrame:
    """One row for each record in an answer {"cards": [...]}, fenced or not; answers that are no JSON give none."""
    body = F.regexp_replace(F.col(answer), r"(?s)^\s*```[a-z]*\s*|\s*```\s*$", "")
    got = F.from_json(body, f"struct<cards: array<{schema}>>", {"mode": "PERMISSIVE"})
    return answers.select("*", F.posexplode(got["cards"]).alias("pos", "card")).drop(answer)


def trusted(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Answered records with clean names that their page bears out, under the issuer the page is known by."""
    rows = found.join(pages.select("source_url", "markdown", F.col("issuer_id").alias("__issuer")), "source_url", "left")
    borne_out = F.filter(F.array(clean(rows["card"]["card_name"])), lambda name: grounded(name, F.col("markdown")))
    # exploded, as a filter on a name makes it again wherever it is spoken of
    rows = rows.select("*", F.explode(borne_out).alias("__name")).withColumn("card", F.col("card").withField("card_name", F.col("__name")))
    return rows.withColumn("issuer_id", F.coalesce(F.nullif("__issuer", F.lit("")), F.col("card.issuer_id"))).drop("__issuer", "markdown", "__name")


def status(answer: Column, n_cards: Column) -> Column:
    """ok, empty (seen, nothing there) or retry (no provider answered)."""
    return F.when(answer.isNull(), "retry").when(n_cards > 0, "ok").otherwise("empty")
