"""Mixing sources to target weights.

Tokens are added up per source (map-side first, so a hot source is a few partial sums). Sources
then share a budget by weight, no source above ``limit`` times its size; what a capped source
can't take is shared again among the rest until none is above. Each document is emitted
floor(rate) times, rate being its source's target over its size, plus one copy when a uniform
number hashed from the seed and the row falls below the rate's fraction.

The per-source table is written to the shared scratch folder. Joining it back needs no hint: it is
broadcast only when its stored size is below the session's threshold, and otherwise shuffled, where
adaptive execution splits a hot source (each source is one row on that side).

Defined cases: NULL text has size 0. NULL source is a source of its own, ordered last. A source of
size 0 has target 0 and its documents are not taken. Repeated rows get the same draw, so reruns
agree. Empty table: empty result. Other columns pass through untouched; the output columns replace
columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import positioned, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
LIMIT = 2.0
SEED = 20240501


def uniform(seed: int, *key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key alone: 52 bits of a SHA-256."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("\x1e")) for k in key])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS, budget: float = BUDGET,
                   limit: float = LIMIT) -> DataFrame:
    """One row per source: source, source_size, target.

    Capped sources only ever grow in number, so the rounds end; each round is one aggregate over
    the per-source table and passes two numbers through the driver.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    ranked = positioned(totals, F.col("source").isNull(), F.col("source"), name="rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stored(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.lit(limit) * F.col("source_size")
    level, held = None, -1
    while True:
        capped = F.lit(False) if level is None else cap <= F.col("weight") * level
        row = table.agg(
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
            F.sum(F.when(capped, cap)).alias("taken"),
            F.sum("source_size").alias("all"), F.count_if(capped).alias("held")).first()
        if row["weight"] is None or row["held"] == held:
            break
        held = row["held"]
        level = (budget * row["all"] - (row["taken"] or 0.0)) / row["weight"]
    share = cap if level is None else F.least(cap, F.col("weight") * level)
    return stored(table.select("source", "source_size", share.cast("double").alias("target")), "targets")


def plan(docs: DataFrame, text: str = "text", source: str = "source", key: tuple[str, ...] = ("doc_id",),
         seed: int = SEED, weights=WEIGHTS, budget: float = BUDGET, limit: float = LIMIT) -> DataFrame:
    """Add size, source_size, target and copies to every row."""
    sized = docs.drop("size", "source_size", "target", "copies").withColumn("size", word_count(F.col(text)))
    targets = source_targets(sized.select(F.col(source), "size"), source, "size", weights, budget, limit)
    targets = targets.withColumnRenamed("source", "__source")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    draw = uniform(seed, *[F.col(k) for k in key])
    return (sized.join(targets, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
            .withColumn("copies", (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")))


def mix(docs: DataFrame, copy: str | None = None, **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, unchanged, each as often as its copies say.

    ``copy`` names a column for the number of the copy, from 1.
    """
    held = docs.select(F.struct("*").alias("__row"), *[F.col(f"`{c}`") for c in docs.columns])
    planned = plan(held, **options).filter(F.col("copies") > 0)
    number = F.explode(F.sequence(F.lit(1), F.col("copies")))
    rows = planned.select("__row", number.alias("__copy"))
    return rows.select("__row.*", *([F.col("__copy").alias(copy)] if copy else []))
