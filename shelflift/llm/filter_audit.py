"""How filters interact: what each one removes at every step of every order in which they can be applied.

* One scan finds which filters each document fails, as a mask of bits; documents are then counted per part and mask (cells).
* A recursive common table expression extends prefixes of orders by the letters they do not hold yet, carrying the applied bits. Its rows join a prefix with a mask;
  each level of the recursion emits what its step does to documents of that mask: they are kept, removed, or fail a filter after another one had removed them.
  Masks and prefixes are bounded by the number of filters (32 x 326 rows for five), whatever the number of documents and parts, so the recursion stays far below
  Spark's limit on recursive rows and is broadcast to the cells, which join it by mask.
* Metrics are summed per part and prefix, and each order takes those of its five prefixes. Shapley: what a filter removes, summed over all orders; a prefix counts
  as often as there are orders that start with it.

Null text: empty. Null part: empty string. Repeated rows count as often as they occur; those alike in id and text are no copies of a smaller id. A null id is neither smaller
than another nor has smaller ones. Labels: a document whose id has several rows is good or toxic if one of them says so; without a row (or id) it is neither. An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelflift.llm.common import pin

FILTERS = "ABCDE"
MAX_FILTERS = 6  # 64 masks x 1,957 prefixes; one more would pass Spark's limit of a million recursive rows
_SPACE = r"\x20\x09-\x0D"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Failures that follow from a text alone: too short, repetitive, shouting, with markup characters."""
    n_words, chars = F.size(words).cast("long"), F.length(text).cast("long")
    capitals = chars - F.length(F.translate(text, _CAPITALS, "")).cast("long")
    return {
        "A": n_words < 50,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n_words,
        "C": 100 * capitals > 5 * chars,
        "D": text.rlike(r"[#$%&*|]"),
    }


def facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of every document; the mask's bit i is set if filter i of ``FILTERS`` fails."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    split = read.withColumn("words", F.regexp_extract_all("text", F.lit(f"[^{_SPACE}]+"), F.lit(0)))
    bits = [F.when(fails, F.lit(1 << FILTERS.index(f))).otherwise(0) for f, fails in text_failures(F.col("text"), F.col("words")).items()]
    stored = pin(split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits, F.lit(0)).alias("mask")), "facts")
    # Texts that occur once have no copies; only the others travel with their smallest id.
    first = stored.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "first")
    first = pin(first, "copied")  # so that both sides of the join are dealt anew and a text with many copies can be split
    copy = F.when(F.col("id") > F.col("first"), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    return stored.join(first, "digest", "left").select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def cells(found: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those that a label calls good or toxic, per part and mask."""
    said = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return found.join(said, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), count("is_good").alias("good"), count("is_toxic").alias("toxic"))


def walk(spark: SparkSession, letters: str = FILTERS) -> DataFrame:
    """(mask, prefix, letter, step, bit, before) of every mask and every prefix of an order; ``before`` has the bits applied before the last letter's."""
    if not 0 < len(letters) <= MAX_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MAX_FILTERS} different letters are needed: {letters!r}")
    filters = ", ".join(f"named_struct('letter', '{f}', 'bit', {1 << i})" for i, f in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE walk (mask, prefix, letter, step, bit, before, applied) AS (
          SELECT explode(sequence(0, {(1 << len(letters)) - 1})), CAST('' AS STRING), CAST('' AS STRING), 0, 0, 0, 0
          UNION ALL
          SELECT mask, concat(prefix, f.letter), f.letter, step + 1, f.bit, applied, applied | f.bit
          FROM (SELECT mask, prefix, step, applied, explode(filter(array({filters}), f -> applied & f.bit = 0)) AS f FROM walk)
        )
        SELECT mask, prefix, letter, step, bit, before FROM walk WHERE step > 0""")


def audit(cells_: DataFrame, letters: str = FILTERS, by: Sequence[str] = ("part",)) -> DataFrame:
    """One row per group of ``by``, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark, n, by = cells_.sparkSession, len(letters), list(by)
    steps = pin(walk(spark, letters), "walk")
    at, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, gone = at.bitwiseAND(bit) != 0, at.bitwiseAND(before) != 0
    total = lambda when, of="n": F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")
    met = cells_.join(F.broadcast(steps), "mask").groupBy(*by, "prefix", "letter", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"), total(at == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"))
    orders_with = F.element_at(F.array(*[F.lit(math.factorial(n - k)).cast("long") for k in range(1, n + 1)]), F.col("step"))
    met = met.withColumn("shapley", F.sum(F.col("removed") * orders_with).over(Window.partitionBy(*by, "letter")))
    orders = steps.filter((F.col("step") == n) & (F.col("mask") == 0)).select(
        F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k"))
    orders = orders.select("filter_order", F.substring("filter_order", F.lit(1), F.col("k")).alias("prefix"))
    return met.join(F.broadcast(orders), "prefix").select(
        *by, "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
