"""Sharding by proportional stratified interleaving.

1. Within each source the rows are shuffled by a hash of the seed, the id and the text's checksum, and ranked.
2. A row's place in the whole is its fractional rank (2 * rank + 1) / (2 * rows of its source), so every
   source is spread evenly over the whole order, whatever its share.
3. The order is cut into equal runs of rows. A run holds a source's rows in proportion to its share, so
   every shard matches the mixture to about one row a source; the shards' counts differ by at most one (law ``rows``).

Both orders are global sorts by range with offsets (``common.positioned``): a hot source is cut into as
many ranges as its rows need, and only one count per range and one row per source meet anywhere. Rows are
placed one by one: equal texts aren't kept together, since a group of copies may be larger than a shard.

Defined cases: a NULL text has size 1 and checksum 0. NULL is a source of its own, ordered last. A NULL id
counts as a value. Repeated rows are placed each by itself and are interchangeable, so reruns agree.
Empty table: empty result. Other columns pass through; output columns replace those of the same names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import positioned, stored
from routeline.llm.mixing import SEED, uniform

SHARDS = 8
LAW = "rows"
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def interleave(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
               shards: int = SHARDS, seed: int = SEED, carry: list[str] | None = None) -> DataFrame:
    """Each row with its shard and its gapless place in it, and the columns ``carry`` (all by default).

    Carried columns travel through two range shuffles: leave the text out where the ids are enough.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")))
    rows = stored(docs.select(
        *carry, F.col(source).alias("__source"), F.col(key).alias("__key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"), crc.alias("text_crc32"),
        uniform(seed, F.col(key), crc).alias("__draw"), F.monotonically_increasing_id().alias("__copy")), "rows")
    by_source = (F.col("__source").isNull(), F.col("__source"))
    ranked = stored(positioned(rows, *by_source, F.col("__draw"), F.col("__key"), F.col("text_crc32"),
                               F.col("size"), F.col("__copy"), name="__at"), "ranked")
    sources = stored(ranked.groupBy(F.col("__source").alias("__of")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")), "sources")
    total = sources.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    rank = F.col("__at") - F.col("__first")
    placed = ranked.join(sources, F.col("__source").eqNullSafe(F.col("__of"))).select(
        *carry, "size", "text_crc32", "__source", rank.alias("__rank"),
        ((2 * rank + 1) / (2 * F.col("__rows"))).alias("__fraction"))
    order = positioned(placed, F.col("__fraction"), *by_source, F.col("__rank"), name="__at")
    cut = order.withColumn("__shard", F.expr(f"__at * {shards} div {max(total, 1)}"))
    first = F.expr(f"(__shard * {total} + {shards - 1}) div {shards}")  # the shard's first place
    return cut.select(*carry, "size", "text_crc32", F.lit(LAW).alias("law"), F.col("__shard").cast("int").alias("shard"),
                      (F.col("__at") - first).cast("bigint").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard, each row in the order of its slot."""
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy(
        "shard").parquet(path)
