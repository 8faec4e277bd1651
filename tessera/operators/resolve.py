"""Resolving records: the fullest of one id, near-duplicate names, matching of two record sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tessera.functions.text import word_set

#: Words that do not tell names of one issuer apart.
NAME_STOP = ("card", "credit", "debit", "prepaid", "forex", "rbl", "bank", "the", "a", "an", "of", "for")
ALIKE = 92


def populated(schema: StructType) -> Column:
    """How many top-level values of a record are there: not null, not empty; zero and false are there."""

    def one(field) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        there = c.isNotNull()
        if isinstance(kind, StringType):
            there = there & (c != "")
        elif isinstance(kind, ArrayType):
            there = there & (F.size(c) > 0)
        return F.coalesce(there, F.lit(False)).cast("int")

    return reduce(lambda a, b: a + b, (one(f) for f in schema.fields))


def fullest(records: DataFrame, key: str = "card_id", seq: str = "seq") -> DataFrame:
    """One record an id: the most populated, the earliest of equals; ``pos`` is where the id came first."""
    given = StructType([f for f in records.schema.fields if f.name not in (key, seq)])
    w = Window.partitionBy(key)
    rows = records.withColumn("__n", populated(given)).withColumn("pos", F.min(seq).over(w))
    return rows.withColumn("__rank", F.row_number().over(w.orderBy(F.col("__n").desc(), seq))).where("__rank = 1").drop("__rank", "__n")


def name_key(name: Column) -> Column:
    """A name's distinctive words in order: names can only be alike if their keys are equal."""
    words = F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in NAME_STOP]))), " ")


def _indel(a: str, b: str) -> float:
    """200 * longest common subsequence / summed lengths."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """100 if one name's words hold the other's; else the best ratio among the shared words and each name's rest."""
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    if x & y and (x <= y or y <= x):
        return 100.0
    one = " ".join(filter(None, (both, " ".join(sorted(x - y)))))
    two = " ".join(filter(None, (both, " ".join(sorted(y - x)))))
    ratios = [_indel(one, two)]
    if both:
        ratios += [_indel(both, one), _indel(both, two)]
    return max(ratios)


def alike(a: str, b: str, least: float = ALIKE) -> bool:
    return bool(a and b) and (a.lower() == b.lower() or token_set_ratio(a, b) >= least)


def collapse_names(records: DataFrame, issuer: str = "issuer_id", name: str = "card_name", seq: str = "seq") -> DataFrame:
    """Within an issuer, records whose names are alike an earlier kept one go; ``kept_by`` names the seq that stays.

    Names are grouped by their distinctive words first. Rows that share a name exactly meet as one before the
    groups are formed, so a group holds spellings, not rows.
    """
    rows = records.withColumn("__key", name_key(F.col(name)))
    spelt = rows.groupBy(issuer, "__key", name).agg(F.min(seq).alias("__seq"))

    def fold(texts: list[str | None]) -> list[int]:
        """The place (from 1) of the spelling that each one goes to."""
        kept: list[tuple[str | None, int]] = []
        out = []
        for at, text in enumerate(texts, 1):
            by = next((s for t, s in kept if alike(t, text)), None)
            if by is None:
                kept.append((text, at))
                by = at
            out.append(by)
        return out

    # a group is one row of an Arrow batch: a call of Python for each group would take milliseconds, and most groups are one name
    folded = F.pandas_udf(lambda groups: groups.map(fold), "array<int>")
    spelling = F.struct(F.col("__seq").isNull().alias("__last"), "__seq", F.col(name).alias("__name"))
    groups = spelt.groupBy(F.col(issuer).alias("__issuer"), "__key").agg(F.array_sort(F.collect_list(spelling)).alias("__held"))
    several = F.size("__held") > 1
    alone = groups.where(~several).select("__issuer", F.col("__held")[0]["__name"].alias("__name"), F.col("__held")[0]["__seq"].alias("kept_by"))
    met = groups.where(several).withColumn("__by", folded(F.col("__held.__name")))
    met = met.select("__issuer", "__held", F.posexplode("__by").alias("__at", "__to"))
    found = alone.unionByName(met.select("__issuer", F.col("__held")[F.col("__at")]["__name"].alias("__name"), F.col("__held")[F.col("__to") - 1]["__seq"].alias("kept_by")))
    same = F.col(issuer).eqNullSafe(F.col("__issuer")) & F.col(name).eqNullSafe(F.col("__name"))
    return rows.drop("__key").join(found, same).drop("__issuer", "__name")


def best_match(rules: DataFrame, others: DataFrame, on: str, name: str = "card_name") -> DataFrame:
    """For each row of ``rules`` (id, on, name) the row of ``others`` (other_id, on, name, seq) of its group with most shared words.

    A group's only candidate is accepted without any; ties go to the smaller seq. (id, other_id, score)
    Names meet as sets of words, once for all rows that have one, and only those that share a word.
    """
    words = F.array_sort(word_set(F.col(name)))
    left = rules.select("id", on, words.alias("__a"))
    right = others.groupBy(on, words.alias("__b")).agg(F.min(F.struct("seq", "other_id")).alias("__at"), F.count(F.lit(1)).alias("__n"))
    sole = right.groupBy(on).agg(F.sum("__n").alias("__n"), F.min("__at").alias("__only"))
    sought = left.select(on, "__a").distinct().select(on, "__a", F.explode("__a").alias("__w"))
    held = right.select(on, "__at", F.explode("__b").alias("__w"))
    shared = sought.join(held, [on, "__w"]).groupBy(on, "__a", "__at").agg(F.count(F.lit(1)).alias("__score"))
    best = shared.groupBy(on, "__a").agg(F.min(F.struct((-F.col("__score")).alias("lost"), F.col("__at"))).alias("__best"))
    rows = left.join(best, [on, "__a"], "left").join(sole, on).where("__best is not null or __n = 1")
    found = F.coalesce(F.col("__best.__at"), F.col("__only"))
    return rows.select("id", found["other_id"].alias("other_id"), F.coalesce(-F.col("__best.lost"), F.lit(0)).cast("int").alias("score"))
