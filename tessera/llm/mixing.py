"""Operator 8: mixing sources to target weights by Sainte-Laguë apportionment.

Every source is an order of its words: documents by a seeded digest, in shards by the digest's first digits.
Blocks of equally many words are given to sources, and each source's blocks to its shards, one at a time to the
highest quotient weight / (2 * seats + 1). A shard then takes its quota as whole passes over its words and one
run of blocks from a seeded start. All of it is integer arithmetic on sizes; no row is made per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, Scratch, bounded_batches, byte_texts, documents, text_or_empty

BLOCK_WORDS = 64
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Words of a source up to which its shards are named by 2, 3 and 4 digits of 16; 5 beyond. A shard has 2 ** 26
#: words or so at most, and a source a million shards.
SHARD_SIZES = (1 << 34, 1 << 38, 1 << 42)
SEED = "mix-1"
_WORDS = re.compile(WORD.encode())
_before = (Window.unboundedPreceding, -1)


def apportion(rows: DataFrame, group: list[str], order: list[str], weight: str, seats: str) -> DataFrame:
    """Adds ``quota``: ``seats`` (equal within a group) given out by highest quotients weight / (2 * quota + 1).

    A divisor at which rounding cannot give more than all seats gives most of them at once; a divisor method is
    house-monotone, so those are the highest quotients. The rest, at most one for each member of the group, goes
    by sorted quotients over a bounded list of candidates. Ties go by ``order``; a weight of zero gets no seat.
    """
    w = Window.partitionBy(*group)
    rows = rows.withColumn("__all", F.sum(weight).over(w)).withColumn("__n", F.count(F.lit(1)).over(w))
    room = F.col(seats) - F.col("__n") / 2.0
    sure = F.when(room > 0, F.floor(F.col(weight) * room / F.col("__all") + 0.5)).otherwise(0)
    rows = rows.withColumn("__sure", F.when(F.col("__all") > 0, sure).otherwise(0).cast("long"))
    rows = rows.withColumn("__left", F.col(seats) - F.sum("__sure").over(w))
    most = F.ceil(F.col("__n") * F.col(weight) / F.col("__all")).cast("long") + 1
    tried = rows.where((F.col(weight) > 0) & (F.col("__left") > 0)).withColumn("__seat", F.explode(F.sequence(F.lit(0).cast("long"), most)))
    quotient = F.col(weight) / (2.0 * (F.col("__sure") + F.col("__seat")) + 1.0)
    ranked = tried.withColumn("__rank", F.row_number().over(w.orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in order])))
    won = ranked.where(F.col("__rank") <= F.col("__left")).groupBy(*group, *order).agg(F.count(F.lit(1)).alias("__won"))
    same = None
    renamed = won.select(*[F.col(c).alias(f"__{c}") for c in dict.fromkeys([*group, *order])], "__won")
    for c in dict.fromkeys([*group, *order]):
        one = F.col(c).eqNullSafe(F.col(f"__{c}"))
        same = one if same is None else same & one
    out = rows.join(renamed, same, "left").withColumn("quota", F.col("__sure") + F.coalesce("__won", F.lit(0)))
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """(source, source_size, weight, target) from (doc_id, source, size).

    Targets share all words by weight, stop at ``passes`` times their source's size, and the excess is shared
    again: sources by ascending limit per unit of weight, each limited while its limit is below the level that
    the words and weights not yet used up give. The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice: Column = F.element_at(F.array(*[F.lit(x) for x in weights]), (at % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", choice).withColumn("limit", F.col("source_size") * passes)
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    used = F.coalesce(F.sum("limit").over(rising.rowsBetween(*_before)), F.lit(0))
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(rising.rowsBetween(*_before)), F.lit(0))
    per = per.withColumn("total", F.sum("source_size").over(every)).withColumn("level", (F.col("total") - used) / left)
    free = F.col("limit") / F.col("weight") >= F.col("level")
    per = per.withColumn("share", F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"), "level"))).over(every)["level"])
    return per.select("source", "source_size", "weight", F.least(F.col("limit").cast("double"), F.col("share") * F.col("weight")).alias("target"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place, name): ``place`` orders documents, ``name`` tells id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), digest.alias("place"), _name().alias("name"))


def _name() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def _digits(source_size: Column) -> Column:
    out: Column = F.lit(len(SHARD_SIZES) + 2)
    for n, most in reversed(list(enumerate(SHARD_SIZES, 2))):
        out = F.when(source_size < most, n).otherwise(out)
    return out


def mixed_parts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, passes: int = MOST_PASSES) -> DataFrame:
    """What the mix takes of every row of ``docs``: ``whole`` passes, and its words at [a0, b0) and [a1, b1).

    The second range is not empty only where a shard's run of blocks wraps around.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.keep(document_sizes(docs), "sizes")
    sources = source_targets(sizes, weights, passes)
    every = Window.partitionBy()
    sources = sources.withColumn("blocks", F.round(F.sum("target").over(every) / block_words).cast("long"))
    sources = apportion(sources.withColumn("one", F.lit(0)), ["one"], ["source"], "target", "blocks")
    sources = sources.select(F.col("source").alias("__s"), "source_size", "target", F.col("quota").alias("blocks"), _digits(F.col("source_size")).alias("digits"))
    sources = scratch.keep(sources, "sources")
    sizes = sizes.join(sources, F.col("source").eqNullSafe(F.col("__s"))).drop("__s").withColumn("shard", F.substring("place", F.lit(1), F.col("digits")))
    cells = sizes.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.min("blocks").alias("blocks"))
    cells = apportion(cells, ["source"], ["shard"], "words", "blocks")
    quota = F.least(F.col("quota") * block_words, F.col("words") * passes)
    seed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce("source", F.lit("")), "shard")), 1, 8), 16, 10).cast("long")
    cells = cells.where("words > 0").select(
        F.col("source").alias("__s"), F.col("shard").alias("__h"), "words", F.floor(quota / F.col("words")).alias("whole"),
        (quota % F.col("words")).alias("more"), (seed % F.ceil(F.col("words") / block_words) * block_words).alias("first"),
    )
    cells = scratch.keep(cells, "cells")
    line = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size", "name").rowsBetween(*_before)
    rows = sizes.withColumn("a", F.coalesce(F.sum("size").over(line), F.lit(0))).withColumn("b", F.col("a") + F.col("size"))
    rows = rows.join(cells, F.col("source").eqNullSafe(F.col("__s")) & (F.col("shard") == F.col("__h")), "left")
    past, none = F.col("first") + F.col("more"), F.lit(0).cast("long")

    def part(i: int, low: Column, high: Column) -> list[Column]:
        """The words of a run that starts at ``low`` and ends before ``high``, counted from the document's first."""
        start = F.greatest(F.col("a"), low) - F.col("a")
        end = F.greatest(start, F.least(F.col("b"), high) - F.col("a"))
        return [F.coalesce(start, none).alias(f"a{i}"), F.coalesce(end, none).alias(f"b{i}")]

    ranges = [*part(0, F.col("first"), F.least(past, F.col("words"))), *part(1, none, past - F.col("words"))]
    return rows.select("doc_id", "name", "source", "size", "source_size", "target", F.coalesce("whole", none).alias("whole"), *ranges)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, passes: int = MOST_PASSES) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of ``docs`` (doc_id, text, source).

    A null source is a source of its own, after all others; a null text has size zero and is never taken; rows
    that share an id are taken separately; a very long text is taken in blocks like any other; an empty table gives
    no row. No shard takes more than ``passes`` times its words, so no document is taken more often than that.
    """
    taken = F.col("whole") * F.col("size") + F.col("b0") - F.col("a0") + F.col("b1") - F.col("a1")
    return mixed_parts(docs, weights, block_words, passes).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def _words_at(text: bytes, start: int, stop: int) -> bytes:
    """The text from its word number ``start`` to the end of word ``stop`` - 1."""
    found = list(islice(_WORDS.finditer(text), start, stop))
    return text[found[0].start() : found[-1].end()] if found else b""


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each whole pass over a document, and one for each range of its words.

    Columns stay; ``n_chars``, where there is one, follows the text. Names that start with ``__mix`` are not
    allowed. Rows that share id, source and text are taken separately.
    """
    spark = docs.sparkSession
    full = F.transform(F.sequence(F.lit(1), F.col("whole")), lambda i: F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b")))
    full = F.when(F.col("whole") > 0, full).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    ends = F.filter(F.array(*[F.struct(F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b")) for i in (0, 1)]), lambda x: x["a"] < x["b"])
    # rows of one name stand for each other: the first of them takes what all take
    parts = mixed_parts(docs, **options).where("size > 0").withColumn("parts", F.concat(full, ends)).where(F.size("parts") > 0)
    parts = parts.groupBy(F.col("name").alias("__mix_name")).agg(F.flatten(F.collect_list("parts")).alias("__mix_parts"), F.max("size").alias("__mix_size"))
    parts = Scratch(spark, "mixed").keep(parts, "parts")
    named = docs.withColumn("__mix_row", _name())
    twice = named.groupBy("__mix_row").count().where("count > 1").select("__mix_row")
    if not twice.isEmpty():
        copies = named.join(twice, "__mix_row", "left_semi").dropDuplicates(["__mix_row"])
        named = named.join(twice, "__mix_row", "left_anti").unionByName(copies)
    rows = named.join(parts, F.col("__mix_row") == F.col("__mix_name")).withColumn("__mix", F.explode("__mix_parts"))
    rows = rows.withColumn("__mix_whole", F.col("__mix.b") - F.col("__mix.a") == F.col("__mix_size"))
    names = docs.columns

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            at = batch["__mix"].to_pylist()
            text = pa.array([_words_at(x, p["a"], p["b"]) for x, p in zip(byte_texts(batch["text"]), at)], pa.binary()).cast(pa.string())
            cols = {c: batch[c] for c in names} | {"text": text}
            if "n_chars" in cols:
                cols["n_chars"] = pc.utf8_length(text).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    bounded_batches(spark)
    cut = rows.where(~F.col("__mix_whole")).select(*names, "__mix").mapInArrow(run, docs.schema)
    return rows.where("__mix_whole").select(*names).union(cut)


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
