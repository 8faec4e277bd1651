"""Operator 6: quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule rejects a document whose share of something is above a cutoff. Labelled documents are split in two by a hash
of their id. The first half proposes: per stratum and rule the cutoff that catches most bad documents beyond a
multiple of the good ones it costs; rules stand in the order of that gain. The second half decides: per stratum
the rules join one after another, and each time the exact binomial probability of so few rejected good documents,
if the true rate were at the limit, is compared with the allowed error. The sequence ends at the first set of rules
that fails, which needs no correction along it; strata are corrected for by Bonferroni. Where too few labels exist to
prove anything, nothing is rejected beyond the base rules: 86 good documents of the second half are the least with
four strata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, documents, text_or_empty

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LIMIT = 0.05
DELTA = 0.05
COST = 20.0
#: Shares from 0.4% to about 90%, each a sixth above the one before.
GRID = [round(0.004 * (7 / 6) ** i, 6) for i in range(36)]
RULES = ("symbols", "dup_lines", "repeats", "shouts", "capitals")
MIN_WORDS = 50
MOST = 1 << 30


def text_counts(docs: DataFrame) -> DataFrame:
    """Adds word, symbol, line and repeat counts of each whole text.

    A null text has no words. Every array is made once in its own projection: windows come from shifted arrays
    instead of look-ups by index, and repeats from neighbours in the sorted hashes of the windows.
    """
    tail = lambda a, n: F.slice(a, n + 1, MOST)
    rows = docs.withColumn("__t", text_or_empty())
    rows = rows.withColumn("__w", F.filter(F.split("__t", f"{SPACE}+"), lambda w: w != ""))
    rows = rows.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        *docs.drop("text").columns,
        F.size("__w").cast("long").alias("n_words"),
        (F.length("__t") - F.regexp_count("__t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("__t", F.lit("!")).cast("long").alias("n_shouts"),
        F.regexp_count("__t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
    )
    pairs = F.zip_with("__h", tail(F.col("__h"), 1), lambda a, b: F.xxhash64(a, b))
    runs = F.zip_with(pairs, tail(F.col("__h"), 2), lambda a, b: F.xxhash64(a, b))
    rows = rows.withColumn("__r", F.when(F.size("__h") > 2, F.slice(runs, F.lit(1), F.size("__h") - 2)).otherwise(F.array().cast("array<bigint>"))).drop("__h")
    some = F.size(F.array_distinct("__r")) < F.size("__r")
    placed = F.sort_array(F.transform("__r", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("__s", F.when(some, placed)).drop("__r")
    equal = F.zip_with("__s", tail(F.col("__s"), 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    found = F.flatten(F.filter(equal, lambda x: x.isNotNull()))
    covered = F.array_distinct(F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2))))
    return rows.withColumn("n_repeat_words", F.when(F.col("__s").isNull(), 0).otherwise(F.size(covered)).cast("long")).drop("__s")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shares() -> dict[str, Column]:
    """What each rule looks at; null where there is nothing to count over."""
    over = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return {
        "symbols": over("n_symbols", "word_chars"),
        "dup_lines": over("n_dup_lines", "n_lines"),
        "repeats": over("n_repeat_words", "n_words"),
        "shouts": over("n_shouts", "n_words"),
        "capitals": over("n_capitals", "word_chars"),
    }


def binomial_log_cdf(n: Column, k: Column, p: float) -> Column:
    """ln P(Binomial(n, p) <= k), summed term by term in logarithms."""
    import math

    odds = math.log(p / (1 - p))
    one = lambda term, total: F.struct(term.alias("term"), total.alias("total"))
    start = (n * math.log(1 - p)).cast("double")

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return one(term, F.greatest(acc["total"], term) + F.log1p(F.exp(-F.abs(acc["total"] - term))))

    ups = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(ups, one(start, start), step)["total"]


def learn_cutoffs(counts: DataFrame, labels: DataFrame, stratum: str, limit: float = LIMIT, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_good_rejected) of the rules of each stratum that are proven together.

    ``counts`` holds (doc_id, stratum column, the counts); only documents that pass the base rules are judged. An
    id labelled more than once counts as good if any label says so; null labels are not used. ``n_good`` and
    ``n_good_rejected`` are of the deciding half, by this rule and those before it.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = counts.where(~base_failed()).join(known, "doc_id")
    grid = F.array(*[F.lit(x) for x in GRID])

    def bucket(share: Column) -> Column:
        """How many cutoffs lie below the share, so cutoff number j (from 1) rejects buckets from j on."""
        return F.size(F.filter(grid, lambda c: c < F.coalesce(share, F.lit(0.0))))

    each = F.array(*[F.struct(F.lit(r).alias("rule"), bucket(s).alias("bucket")) for r, s in shares().items()])
    proposing = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = rows.select(F.col(stratum).alias("stratum"), (F.col("quality") == 1).alias("good"), proposing.alias("proposing"), each.alias("each"))
    # one row for each document only: at most as many rows as labels
    found = rows.where("proposing").select("stratum", "good", F.inline("each")).groupBy("stratum", "rule", "bucket").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    down = Window.partitionBy("stratum", "rule").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = found.select("*", F.sum("good").over(down).alias("k"), F.sum("bad").over(down).alias("caught")).where("bucket > 0")
    found = found.withColumn("gain", F.col("caught") - cost * F.col("k")).where("gain > 0")
    best = F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(F.col("gain").desc(), F.col("bucket").desc()))
    found = found.withColumn("best", best).where("best = 1")
    place = F.row_number().over(Window.partitionBy("stratum").orderBy(F.col("gain").desc(), "rule"))
    proposed = found.select("stratum", "rule", "bucket", place.alias("place"))
    # the first rule, in its stratum's order, that rejects a good document of the other half
    wide = proposed.groupBy(F.col("stratum").alias("__s")).agg(F.collect_list(F.struct("rule", "bucket", "place")).alias("rules"))
    judged = rows.where("good and not proposing").join(wide, F.col("stratum").eqNullSafe(F.col("__s")))
    hit = F.array_min(F.transform(F.filter("rules", lambda r: F.exists("each", lambda e: (e["rule"] == r["rule"]) & (e["bucket"] >= r["bucket"]))), lambda r: r["place"]))
    per = judged.select("stratum", F.coalesce(hit, F.lit(0)).alias("hit")).groupBy("stratum", "hit").agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy(F.col("stratum").alias("__s")).agg(F.collect_list(F.struct("hit", "n")).alias("hits"), F.sum("n").alias("n_good"))
    strata = rows.select(F.col("stratum").alias("__t")).distinct().withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy()))  # a row a stratum
    tested = proposed.join(per, F.col("stratum").eqNullSafe(F.col("__s"))).join(strata, F.col("stratum").eqNullSafe(F.col("__t")))
    k = F.aggregate(F.filter("hits", lambda h: (h["hit"] > 0) & (h["hit"] <= F.col("place"))), F.lit(0).cast("long"), lambda a, h: a + h["n"])
    tested = tested.withColumn("k", k)
    proven = F.when(F.col("k") >= F.col("n_good") * limit, F.lit(False)).otherwise(binomial_log_cdf(F.col("n_good"), F.col("k"), limit) <= F.log(delta / F.col("strata")))
    fails = F.max((~proven).cast("int")).over(Window.partitionBy("stratum").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return tested.withColumn("fails", fails).where("fails = 0").select("stratum", "rule", F.element_at(grid, F.col("bucket")).alias("cutoff"), "n_good", F.col("k").alias("n_good_rejected"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """The counts of every row of ``docs`` (doc_id, text, stratum column) with base_failed and kept.

    Null and empty texts fail the base rules; a null stratum is one of its own; rows that share an id are judged
    each; without labels only the base rules act; very long texts are counted whole; an empty table gives no row;
    other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    counts = scratch.keep(text_counts(docs.select("doc_id", F.col(stratum).alias("stratum"), "text")), "counts")
    cutoffs = learn_cutoffs(counts, labels, "stratum", limit, delta)
    # one row a stratum; as a written table its size is known when the join is planned
    wide = cutoffs.groupBy(F.col("stratum").alias("__s")).agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__{r}") for r in RULES])
    wide = scratch.keep(wide.coalesce(1), "cutoffs")
    rows = counts.join(wide, F.col("stratum").eqNullSafe(F.col("__s")), "left").withColumn("base_failed", base_failed())
    bad = F.lit(False)
    for rule, share in shares().items():
        bad = bad | F.coalesce(share > F.col(f"__{rule}"), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~bad)


def op6_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
