"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests: its lines, cut further at sentence ends so that a text of one
line still has parts; a repeated paragraph counts once. A sketch of a size has three subtables.
Every digest falls into one cell of each; a cell holds a count, the xor of its digests and the xor
of their check hashes. Two sketches of one size subtract cell by cell, which cancels everything the
texts share. The rest is peeled: a cell whose count is 1 or -1 and whose check fits holds a single
digest; it is recovered and taken out of its other two cells, which exposes more. Peeling goes by
subtable in turn, so that a digest alone in several of its cells is taken out once. Cells left
after the last turn mean the sketch was too small: the pair is tried again at GROWTH times the size,
until every pair is recovered. A pair starts at the size its two digest counts would fill at worst.

With d recovered digests of two texts that have a and b, likeness is (a + b - d) / (a + b + d), the
Jaccard index of the two sets; two texts without digests are alike.

Cells are rows keyed by pair (only non-empty cells exist), and all turns of a size run in one stage,
because every aggregate keeps the partitioning by pair; a long document is many rows, not one large
value. Texts are shuffled once; after that only digests travel.

Every row gives one row. Rows are ordered by id (NULL first), then text hash, then copy; the next
document of a row is the one after it in this order, the first after the last. Rows alike in id and
text are worked on once with their number of copies: the next of the last copy is the next group's
text, that of the other copies is their own text.

Defined cases: NULL text counts as empty: no digests, an empty fingerprint. A single document is its
own next. Empty table: empty result. Other columns don't enter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import positioned, stored

UNIT_END = r"\n|(?<=[.!?])[ \t]+"
SUBTABLES = 3
SHOWN_SIZE = 4       # cells per subtable of the sketch that is written out as text
FILL = 1.7           # cells per digest at the first size, in the worst case
LEAST_SIZE = 32      # cells per subtable
GROWTH = 8
TURNS = 12           # subtable turns per size
PARTITION_DIGESTS = 400_000
COPIES_PER_TASK = 100_000
GROUP = ["has_id", "id", "text_hash"]  # rows alike in these are copies; also their order


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    parts = F.filter(F.split(text, UNIT_END), lambda x: x != "")
    return F.array_distinct(F.transform(parts, lambda x: F.shiftright(F.xxhash64(x), 32).cast("int")))


def _slot(digest: Column, subtable: int, size: Column) -> Column:
    return (F.pmod(F.xxhash64(digest, F.lit(subtable + 1)), size) + size * subtable).cast("int")


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def placed(items: Column, size: int = SHOWN_SIZE) -> Column:
    """Each digest with its check hash and its cell in every subtable of a sketch of ``size``."""
    return F.transform(items, lambda x: F.struct(
        x.cast("bigint").alias("k"), _check(x).alias("c"),
        *[_slot(x, j, F.lit(size)).alias(f"s{j}") for j in range(SUBTABLES)]))


def written(cells: Column, size: int = SHOWN_SIZE) -> Column:
    """A sketch as text, slot:count:xor:check of every non-empty cell; ``cells`` is a column of ``placed``."""
    def cell(slot: Column, members: Column) -> Column:
        fold = lambda f: F.hex(F.aggregate(members, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(
            x[f])).bitwiseAND(F.lit(0xFFFFFFFF)))
        return F.when(F.size(members) > 0, F.concat_ws(
            ":", slot.cast("string"), F.size(members).cast("string"), fold("k"), fold("c")))

    def subtable(j: int) -> Column:
        slots = F.sequence(F.lit(size * j), F.lit(size * (j + 1) - 1))
        # members first, so that a cell's four figures don't search for them four times
        groups = F.transform(slots, lambda s: F.struct(
            s.alias("slot"), F.filter(cells, lambda x: x[f"s{j}"] == s).alias("members")))
        return F.transform(groups, lambda g: cell(g.slot, g.members))

    return F.array_join(F.concat(*map(subtable, range(SUBTABLES))), ";")


def start_size(total: Column) -> Column:
    """Cells per subtable: the power of two that holds ``total`` digests at FILL cells each."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(total * F.lit(FILL / SUBTABLES), F.lit(float(LEAST_SIZE)))))).cast("int")


def sketch(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, size, slot, n, k, c): the non-empty cells of each pair's difference sketch.

    ``items`` holds keys, size, digest and sign (1 for one side, -1 for the other).
    """
    cells = items.select(*keys, "size", "digest", "sign", F.explode(
        F.array(*[_slot(F.col("digest"), j, F.col("size")) for j in range(SUBTABLES)])).alias("slot"))
    return (cells.groupBy(*keys, "size", "slot")
            .agg(F.sum("sign").cast("int").alias("n"), F.bit_xor(F.col("digest").cast("bigint")).alias("k"),
                 F.bit_xor(_check(F.col("digest"))).alias("c"))
            .filter("n <> 0 or k <> 0 or c <> 0"))


def peel(cells: DataFrame, keys: list[str], turns: int = TURNS) -> DataFrame:
    """(keys, size, slot, found, n): recovered digests in ``found`` (slot -1), cells that stay.

    A turn looks at one subtable: its single-digest cells become the digest and two corrections.
    """
    def row(slot, found, n, k, c):
        return F.struct(slot.cast("int").alias("slot"), found.cast("int").alias("found"), n.cast("int").alias("n"),
                        k.cast("bigint").alias("k"), c.cast("bigint").alias("c"))

    now = cells.withColumn("found", F.lit(0))
    for turn in range(turns):
        table = turn % SUBTABLES
        held = F.col("k").cast("int")
        alone = ((F.col("slot") >= F.col("size") * table) & (F.col("slot") < F.col("size") * (table + 1))
                 & (F.abs("n") == 1) & (F.col("k") == held.cast("bigint")) & (F.col("c") == _check(held)))
        taken = F.array(
            row(F.lit(-1), held, F.col("n"), F.lit(0), F.lit(0)),
            *[row(_slot(held, j, F.col("size")), F.lit(0), -F.col("n"), F.col("k"), F.col("c"))
              for j in range(SUBTABLES) if j != table])
        stays = F.array(row(F.col("slot"), F.col("found"), F.col("n"), F.col("k"), F.col("c")))
        out = now.select(*keys, "size", F.explode(F.when(alone, taken).otherwise(stays)).alias("r"))
        now = (out.select(*keys, "size", "r.*").groupBy(*keys, "size", "slot", "found")
               .agg(F.sum("n").cast("int").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
               .filter("slot = -1 or n <> 0 or k <> 0 or c <> 0"))
    return now


def recover(pairs: Callable[[DataFrame | None], DataFrame], keys: list[str], lists: bool = True) -> DataFrame:
    """(keys, n_left, n_right[, only_left, only_right]): what each side of a pair has alone.

    ``pairs`` gives rows of keys and two digest arrays ``left`` and ``right``, partitioned by the
    keys or a part of them: all of them for None, else those of a table of keys. With ``lists`` the
    recovered digests are returned, else their numbers. Pairs without any digest may be missing.
    """
    left = pairs(None)
    left, done = left.withColumn("size", start_size((F.size("left") + F.size("right")).cast("double"))), None
    while True:
        sides = left.select(*keys, "size", F.explode(F.array(
            F.struct(F.lit(1).alias("sign"), F.col("left").alias("all")),
            F.struct(F.lit(-1).alias("sign"), F.col("right").alias("all")))).alias("s"))
        items = sides.select(*keys, "size", "s.sign", F.explode("s.all").alias("digest"))
        peeled = peel(sketch(items, keys), keys)
        only = lambda n: (F.col("slot") == -1) & (F.col("n") == n)
        figures = [F.count_if(F.col("slot") >= 0).alias("cells"),
                   F.count_if(only(1)).alias("n_left"), F.count_if(only(-1)).alias("n_right")]
        if lists:
            figures += [F.collect_list(F.when(only(1), F.col("found"))).alias("only_left"),
                        F.collect_list(F.when(only(-1), F.col("found"))).alias("only_right")]
        state = stored(peeled.groupBy(*keys, "size").agg(*figures), "peeled")
        whole = state.filter("cells = 0").drop("cells", "size")
        done = whole if done is None else done.union(whole)
        failed = state.filter("cells > 0").select(*keys, (F.col("size") * GROWTH).alias("size"))
        if failed.isEmpty():
            return done
        failed = stored(failed, "failed")
        left = pairs(failed.select(*keys)).join(failed, keys)


def _neighbours(groups: DataFrame) -> DataFrame:
    """groups with their position, and position, length and columns of the group before; the first's is the last."""
    placed = stored(positioned(groups, *map(F.col, GROUP)), "order")
    n = max(placed.count(), 1)
    before = placed.select(
        F.pmod(F.col("position") + 1, F.lit(n)).alias("position"), F.col("position").alias("previous_position"),
        F.col("n_chars").alias("previous_chars"), *[F.col(c).alias(f"previous_{c}") for c in GROUP])
    return placed.join(before, "position")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 4) -> DataFrame:
    """Rows written to scratch: digests of a text, those of its edited text, both sketches, and ``times``.

    The edited text has the beginning of the next document's in place of its last 1/``share``. A
    group of copies has a row for its last copy (even key) and, if there are more, one for the
    ``times`` others (odd key). ``previous_key`` is the row whose next document is this one's text.
    """
    source = docs.select(
        F.col(doc_id).isNotNull().alias("has_id"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    groups = source.select(*GROUP, F.length("text").cast("bigint").alias("n_chars")).groupBy(*GROUP).agg(
        F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    groups = stored(_neighbours(groups), "neighbours")
    if (groups.agg(F.max("copies")).first()[0] or 0) > 1:
        source = source.dropDuplicates(GROUP)
    # the one shuffle of the texts, by group, also serves the join with the heads
    chosen = source.join(groups, GROUP)
    # what the group before needs of this text
    quarter = lambda n: F.floor(F.col(n) / share).cast("int")
    heads = chosen.select(*[F.col(f"previous_{c}").alias(c) for c in GROUP],
                          F.substr(F.col("text"), F.lit(1), quarter("previous_chars")).alias("head"))
    keep = (F.col("n_chars") - quarter("n_chars")).cast("int")
    last = F.struct((F.col("position") * 2).alias("key"), (F.col("previous_position") * 2).alias("previous_key"),
                    F.lit(1).cast("bigint").alias("times"), F.col("head").alias("head"))
    own = F.col("position") * 2 + 1
    others = F.struct(own.alias("key"), own.alias("previous_key"), (F.col("copies") - 1).alias("times"),
                      F.substr(F.col("text"), F.lit(1), quarter("n_chars")).alias("head"))
    both = chosen.join(heads, GROUP).select("has_id", "id", "n_chars", "text", F.explode(F.array_compact(F.array(
        last, F.when(F.col("copies") > 1, others)))).alias("copy"))
    both = both.withColumn("edited", F.concat(F.substr(F.col("text"), F.lit(1), keep), F.col("copy.head")))
    rows = both.select(
        "copy.key", "copy.previous_key", "copy.times", F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("other"))
    rows = rows.withColumns({"own_cells": placed(F.col("own")), "other_cells": placed(F.col("other"))})
    rows = rows.withColumns({"fingerprint": written(F.col("own_cells")), "edited_fingerprint": written(F.col("other_cells"))})
    rows = rows.withColumn("n_own", F.size("own"))
    return stored(rows.drop("own_cells", "other_cells"), "fingerprints")


def compare(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and its edited text, and their likenesses."""
    rows = fingerprint(docs, doc_id, text)
    counts, most = rows.agg(F.sum(F.size("own") + F.size("other")), F.max("times")).first()
    parts = min(100_000, max(1, -(-2 * (counts or 0) // PARTITION_DIGESTS)))

    def pairs(only: DataFrame | None) -> DataFrame:
        own = rows.select("key", "own", "other")
        following = rows.select(F.col("previous_key").alias("key"), F.col("own").alias("next"))
        if only is not None:
            keys = only.select("key").distinct()
            own, following = own.join(keys, "key", "left_semi"), following.join(keys, "key", "left_semi")
        # both sides by key, into parts of a bounded number of digests: every later aggregate stays in place
        met = own.repartition(parts, "key").join(following.repartition(parts, "key"), "key")
        return met.select("key", F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("own").alias("left"), F.col("other").alias("right")),
            F.struct(F.lit(1).alias("kind"), F.col("own").alias("left"), F.col("next").alias("right")))).alias("p")
        ).select("key", "p.*")

    found = recover(pairs, ["key", "kind"], lists=False)
    apart = found.groupBy("key").agg(*[
        F.max(F.when(F.col("kind") == k, F.col("n_left"))).alias(f"left_{k}") for k in (0, 1)], *[
        F.max(F.when(F.col("kind") == k, F.col("n_right"))).alias(f"right_{k}") for k in (0, 1)])
    # a pair without cells at all has no row: nothing differs
    shared = lambda k: F.col("n_own") - F.coalesce(f"left_{k}", F.lit(0))
    united = lambda k: F.col("n_own") + F.coalesce(f"right_{k}", F.lit(0))
    near = lambda k: F.coalesce(F.try_divide(shared(k).cast("double"), united(k).cast("double")), F.lit(1.0))
    shown = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out = rows.join(apart, "key", "left").withColumns({"near_edited": near(0), "near_next": near(1)})
    if (most or 1) == 1:
        return out.select(*shown)
    # copies are dealt out a bounded number at a time
    out = out.select("key", "times", *shown, F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("times") - 1, F.lit(COPIES_PER_TASK).cast("bigint"))).alias("first"))
    if most > COPIES_PER_TASK:
        out = out.repartition("key", "first")
    return out.select(*shown, F.explode(F.sequence(
        "first", F.least(F.col("first") + COPIES_PER_TASK, F.col("times")) - 1)).alias("copy")).drop("copy")
