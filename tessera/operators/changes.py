"""The change feed between an old and a new set of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The watched paths of extracted and of published records.
WATCHED_V1 = (
    "fees.joining_fee_inr", "fees.annual_fee_inr", "fees.fee_waiver_spend_inr", "fees.fx_markup_pct",
    "rewards.base_rate_pct", "rewards.point_value_inr", "lounge_access.domestic_visits_year",
    "lounge_access.international_visits_year", "status",
)
WATCHED_V2 = (
    "fees.joining_inr", "fees.annual_inr", "fees.waiver_spend_inr", "fees.fx_markup_pct", "rewards.base_rate_pct",
    "rewards.unit_value_inr", "lounge_access.domestic_year", "lounge_access.international_year", "status",
)
LOST_STATUS = ("discontinued", "invite_only")


def devalued(field: Column, old: Column, new: Column, old_number: Column, new_number: Column) -> Column:
    """A rise under fees, a fall under rewards or lounges, a status that closes the product."""
    up = field.startswith("fees.") & (new_number > old_number)
    down = field.rlike(r"^(rewards|lounge_access)\.") & (new_number < old_number)
    return F.coalesce(F.when(field == "status", new.isin(*LOST_STATUS)).otherwise(up | down), F.lit(False))


def changes(old: DataFrame, new: DataFrame, run_ts: str, watched: tuple[str, ...] = WATCHED_V1, key: str = "card_id") -> DataFrame:
    """One row for each watched value that differs between the records of one id; both null is no change."""

    def flat(rows: DataFrame, side: str) -> DataFrame:
        pairs = [F.struct(F.lit(p).alias("field"), F.col(p).cast("string").alias("value")) for p in watched]
        return rows.select(key, *([F.col("source_url")] if side == "new" else []), F.array(*pairs).alias(side))

    rows = flat(new, "new").join(flat(old, "old"), key)
    rows = rows.select(key, "source_url", F.inline(F.arrays_zip("old", "new")))
    rows = rows.select(key, "source_url", F.col("new.field").alias("field"), F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))
    rows = rows.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    before, after = F.col("old_value").try_cast("double"), F.col("new_value").try_cast("double")
    worse = devalued(F.col("field"), F.col("old_value"), F.col("new_value"), before, after)
    return rows.withColumns(
        {
            "old_number": before,
            "new_number": after,
            "change_type": F.when(worse, "devaluation").otherwise("change"),
            "detected_at": F.lit(run_ts),
            "change_id": F.concat_ws("#", F.col(key), "field", F.lit(run_ts)),
        }
    )


def appeared(old: DataFrame, new: DataFrame, key: str = "card_id") -> DataFrame:
    """Records without a predecessor."""
    return new.join(old.select(key), key, "left_anti")
