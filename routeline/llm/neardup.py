"""Near-duplicate classes by b-bit MinHash.

1. One pass over the texts: distinct word shingles are hashed, and each text yields its set size, a
   128-bit digest of the set, hashes of BANDS groups of minima over independent permutations, and a
   b-bit signature: the minima of LANES parts of one permutation, each cut to two bits (0 for a part
   without shingles, else one of three values), packed into thirty-two words.
2. Texts with equal sets (groups of exact copies, however large) become one class through the
   digest, an aggregate that is combined before its shuffle. Only one node per class goes on.
3. Nodes that share a band are candidates. Groups are never paired off. In each round a group has a
   few centres (first the node with most copies, then 64, 4096, ... by hash, or all members outside the
   group's commonest component where these are at most WIDE times as many), each compared only with
   members not yet known to be linked to it. Up to SMALL members, the pairs are named by their ids and
   signatures join the distinct ones; in a larger group the signatures come to the members, which meet
   the centres in blocks of about BLOCK, and a pair counts only in the first band that it shares. A
   centre leaves its group after its round, and a group ends when its remaining members carry one
   label. So every pair of a group is either compared or already known to be in one component: no link
   between components is lost, and a group of n alike copies costs n comparisons.
4. A candidate first passes a size bound and the similarity estimated from the packed words by bit
   counts: of u lanes filled in either node and b filled in both, e are equal; a third of unequal
   fillings agree by chance, so s = (e - b/3) / (2/3) / u. It must come within SLACK standard
   deviations of the threshold. What remains is confirmed on the full shingle sets of the two texts.
5. Links become components by alternating large-star and small-star steps over distributed tables.

With 25 bands of 5 minima a pair at similarity 0.85 shares no band with probability 4e-7.

Defined cases: NULL or blank text: empty set, size 0, linked with nothing. Fewer words than a
shingle: the whole word sequence is one shingle. Rows that share an id are each
answered by their own text. A row without an id is linked with nothing and kept; its component is
NULL. Repeated rows get equal answers. Empty table: empty result. Other columns don't enter; ``keep_one`` returns all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import (
    BASE_B, lower_ascii, mix, signed, span_hash, stored, text_chunks, windows, word_hashes, word_spans,
)
from routeline.session import scratch_path

SHINGLE, PERCENT = 3, 85
BANDS, BAND_ROWS = 25, 5
MINIMA = BANDS * BAND_ROWS
LANES = 1024
WORDS = LANES // 32
SLACK = 4.5
FAN = 64
WIDE = 8  # up to WIDE times a round's centres outside its commonest component, a group is compared whole
SMALL = 32
BLOCK = 512
SEED = 20240501

SIGNATURE = [f"s{i}" for i in range(WORDS)]
FEATURES = ("struct<n:bigint,d1:bigint,d2:bigint,bands:array<bigint>," + ",".join(f"{s}:bigint" for s in SIGNATURE) + ">")


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk: distinct shingle hashes ordered by text, and where each text's begin."""
    for _, data, offsets in text_chunks(texts):
        data = lower_ascii(data)
        starts, ends, text_words = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        at = windows(text_words, size)
        counts = np.diff(text_words)
        short = np.flatnonzero((counts > 0) & (counts < size))
        h = np.concatenate([span_hash(words, at, at + size, BASE_B),
                            span_hash(words, text_words[short], text_words[short + 1], BASE_B)])
        owner = np.concatenate([np.searchsorted(text_words, at, side="right") - 1, short])
        # texts without words share their successor's offset; the last text at an offset owns it
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[first], owner[first]
        yield h, np.searchsorted(owner, np.arange(len(offsets)))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    return (draw.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            draw.integers(0, 1 << 32, MINIMA, dtype=np.uint32))


def minima(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MINIMA minima per text, texts without shingles get the largest value."""
    a, b = _permutations()
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(begin) - 1, MINIMA), 0xFFFFFFFF, dtype=np.uint32)
    step = 4096
    for lo in range(0, len(x), step):
        hi = min(lo + step, len(x))
        first = int(np.searchsorted(begin, lo, side="right")) - 1
        last = int(np.searchsorted(begin, hi, side="left"))
        rows = np.arange(first, last)
        rows = rows[begin[rows + 1] > np.maximum(begin[rows], lo)]
        cut = np.maximum(begin[rows], lo) - lo
        block = np.minimum.reduceat(x[lo:hi, None] * a + b, cut, axis=0)
        out[rows] = np.minimum(out[rows], block)
    return out


def packed(h: np.ndarray, begin: np.ndarray, rows: int = 512) -> np.ndarray:
    """Texts x WORDS: two bits of the smallest hash in each lane, 0 for an empty lane.

    The low bits of all lanes fill the first half of the words, the high bits the second. ``rows`` texts are
    laid out at a time, so a chunk of many short texts takes no more memory than one of a few long ones.
    """
    parts = [_packed(h[begin[i]:begin[min(i + rows, len(begin) - 1)]], begin[i:i + rows + 1] - begin[i])
             for i in range(0, len(begin) - 1, rows)]
    return np.concatenate(parts) if parts else np.zeros((0, WORDS), np.uint64)


def _packed(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    n = len(begin) - 1
    owner = np.repeat(np.arange(n), np.diff(begin))
    part = mix(h ^ np.uint64(0xA4093822299F31D0))
    lane = owner * LANES + (part >> np.uint64(64 - LANES.bit_length() + 1)).astype(np.int64)
    order = np.lexsort((part, lane))
    lane, part = lane[order], part[order]
    first = np.ones(len(lane), bool)
    first[1:] = lane[1:] != lane[:-1]
    lanes = np.zeros(n * LANES, np.uint64)
    lanes[lane[first]] = mix(part[first]) % np.uint64(3) + np.uint64(1)
    lanes = lanes.reshape(n, WORDS // 2, 64)
    place = np.arange(64, dtype=np.uint64)
    low = np.bitwise_or.reduce((lanes & np.uint64(1)) << place, axis=2)
    high = np.bitwise_or.reduce((lanes >> np.uint64(1)) << place, axis=2)
    return np.concatenate([low, high], axis=1)


def features(size: int = SHINGLE):
    """Arrow UDF text -> set size, set digest, band hashes, packed low bits."""
    @F.arrow_udf(FEATURES)
    def signature(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            columns: list[list[np.ndarray]] = [[] for _ in range(4 + WORDS)]
            for h, begin in shingle_sets(part, size):
                n = np.diff(begin)
                filled = np.flatnonzero(n)
                digest = []
                for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
                    d = np.zeros(len(n), dtype=np.uint64)
                    if len(filled):
                        d[filled] = np.add.reduceat(mix(h ^ np.uint64(salt)), begin[filled])
                    digest.append(signed(d))
                least = minima(h, begin).astype(np.uint64)
                band = np.zeros((len(n), BANDS), dtype=np.uint64)
                for r in range(BAND_ROWS):
                    band = mix(band + least[:, r::BAND_ROWS] + np.uint64(r + 1))
                band = mix(band + np.arange(BANDS, dtype=np.uint64))
                bits = signed(np.ascontiguousarray(packed(h, begin).T))
                for column, values in zip(columns, [n, *digest, signed(band), *bits], strict=True):
                    column.append(values)
            flat = [np.concatenate(c) if c else np.zeros((0, BANDS) if i == 3 else 0, np.int64)
                    for i, c in enumerate(columns)]
            arrays = [pa.array(c.astype(np.int64)) for i, c in enumerate(flat) if i != 3]
            offsets = pa.array(np.arange(len(flat[3]) + 1, dtype=np.int32) * BANDS, pa.int32())
            bands = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[3]).ravel()))
            arrays.insert(3, bands)
            yield pa.StructArray.from_arrays(arrays, names=["n", "d1", "d2", "bands", *SIGNATURE])

    return signature


def confirmer(size: int = SHINGLE):
    """Arrow UDF (text, text) -> shared and united shingles, from the full sets."""
    @F.arrow_udf("struct<shared:bigint,united:bigint>")
    def confirm(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in parts:
            shared, united = [], []
            lefts = ((h[b[i]:b[i + 1]]) for h, b in shingle_sets(left, size) for i in range(len(b) - 1))
            rights = ((h[b[i]:b[i + 1]]) for h, b in shingle_sets(right, size) for i in range(len(b) - 1))
            for x, y in zip(lefts, rights, strict=True):
                both = np.sort(np.concatenate([x, y]))
                k = int((both[1:] == both[:-1]).sum())
                shared.append(k)
                united.append(len(x) + len(y) - k)
            yield pa.StructArray.from_arrays([pa.array(shared, pa.int64()), pa.array(united, pa.int64())],
                                             names=["shared", "united"])

    return confirm


def signed_nodes(nodes: DataFrame, percent: int, *columns: Column | str) -> DataFrame:
    """``nodes`` with their sizes, signatures and numbers of filled lanes, declared never NULL.

    Without the NULL checks and the exponentials, which are taken here once a node, the comparison stays a
    method small enough for the JVM to compile: ``void`` is the share of lanes that a set of this size leaves empty,
    and the product of two ``spare`` that which the united set does if the similarity is just ``percent``.
    """
    zero = F.lit(0).cast("bigint")
    filled = F.lit(0)
    for low, high in zip(SIGNATURE[:WORDS // 2], SIGNATURE[WORDS // 2:]):
        filled = filled + F.bit_count(F.col(low).bitwiseOR(F.col(high)))
    empty = lambda lanes: F.coalesce(F.exp(-F.col("n") / F.lit(float(lanes))), F.lit(1.0))
    return nodes.select("node", *columns, F.coalesce(filled, F.lit(0)).alias("filled"),
                        empty(LANES).alias("void"), empty(LANES * (1 + percent / 100)).alias("spare"),
                        *[F.coalesce(c, zero).alias(c) for c in ("n", *SIGNATURE)])


def likely(left: str, right: str, percent: int) -> Column:
    """Size bound, then the corrected estimate within SLACK deviations of the threshold."""
    both, unequal = F.lit(0), F.lit(0)
    for low, high in zip(SIGNATURE[:WORDS // 2], SIGNATURE[WORDS // 2:]):
        x0, x1, y0, y1 = (F.col(f"{side}.{s}") for side in (left, right) for s in (low, high))
        both = both + F.bit_count(x0.bitwiseOR(x1).bitwiseAND(y0.bitwiseOR(y1)))
        unequal = unequal + F.bit_count(x0.bitwiseXOR(y0).bitwiseOR(x1.bitwiseXOR(y1)))
    fills = F.col(f"{left}.filled") + F.col(f"{right}.filled")
    s = percent / 100
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    # What to expect of two sets at similarity s: lanes filled in either, those filled in both but
    # unequal (a third agree by chance; few where the sets are small), and how far equal lanes stray,
    # since lanes sample the united set without replacement. Only the sizes enter.
    united = (n + m) / F.lit(1 + s)
    empty = F.col(f"{left}.spare") * F.col(f"{right}.spare")
    lanes = (1 - empty) * float(LANES)
    missed = F.greatest(F.lit(0.05), 1 - lanes / united)
    chance = (1 - F.col(f"{left}.void") - F.col(f"{right}.void") + empty) * float(LANES) - lanes * s
    chance = F.greatest(chance, F.lit(0.0)) * 1.5 + 2
    deviation = F.sqrt(lanes * s * (1 - s) * missed + chance / 2)
    # equal lanes are (either - unequal - both/3) / (2/3); they should be s * either = s * (fills - both)
    above = fills * F.lit(1.5 - s) - unequal * F.lit(1.5) - both * F.lit(2 - s)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (above >= deviation * -SLACK)


def _likely_pairs(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass size bound and estimate; a signature travels once for each pair."""
    a, b = (bits.withColumnRenamed("node", f"__{x}").alias(f"side_{x}") for x in "ab")
    return (pairs.join(a, F.col("a") == F.col("__a")).join(b, F.col("b") == F.col("__b"))
            .filter(likely("side_a", "side_b", percent)).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected edges (a, b): label is the smallest reachable.

    Large-star links each node's larger neighbours to its smallest neighbour, small-star its
    smaller ones. Both are aggregates and equi-joins; the edge table is written each round, until
    every component is a star around its smallest node.
    """
    def tidy(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        # rows (u, v): large looks from both ends, small only from the larger end down
        down = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        near = down.union(e.select(F.col("a").alias("u"), F.col("b").alias("v"))) if large else down
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        joined = near.join(least, "u")
        if large:
            moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            return tidy(moved)
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        return tidy(moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))

    def settled(e: DataFrame) -> bool:
        # stars only: every larger end once, and never a smaller end itself; edges always lead to the smaller id
        ends = e.select(F.col("b").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
            e.select(F.col("a").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        ends = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        return ends.filter("down + up > 1 and down > 0").isEmpty()

    edges = stored(tidy(edges), "edges")
    while not settled(edges):
        edges = stored(star(star(edges, large=True), large=False), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label"))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further links (a, b): only components that meet are worked on.

    The smallest node of a component has no row and stands for itself, as does a node without links.
    """
    met = links
    for end in ("a", "b"):
        met = met.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left")
    new = components(met.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")))
    moved = labels.join(new.select(F.col("node").alias("label"), F.col("label").alias("now")), "label", "left")
    return stored(moved.select("node", F.coalesce("now", "label").alias("label")).union(new), "labels")


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    # the ends are written first, so their size is known when the join is planned; then only the texts of ends travel,
    # once: both joins read the same shuffle of (node, text)
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    texts = docs.select("node", "text").join(ends, "node", "left_semi")
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    found = both.withColumn("found", confirmer(size)("text_a", "text_b"))
    # a pair comes again where ids repeat; components() makes links distinct
    return found.filter(F.col("found.shared") * 100 >= F.col("found.united") * percent).select("a", "b")


def classify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    source = docs.select(F.col(doc_id).alias("node"), F.col(text).alias("text"))
    seen = stored(source.withColumn("f", features(size)("text")).select("node", "f.*"), "shingles")
    filled = seen.filter("n > 0 and node is not null")
    # one node per distinct set; its band hashes and bits are the same for all rows of the class
    copied = filled.groupBy("d1", "d2", "n").agg(F.min("node").alias("node"), F.count("*").alias("copies"))
    nodes = stored(
        filled.join(copied.select("node", "d1", "d2", "copies"), ["node", "d1", "d2"])
        .dropDuplicates(["node", "d1", "d2"]), "nodes")
    classes = nodes.select("d1", "d2", "n", "node")
    bits = signed_nodes(nodes, percent)

    by_band = nodes.select("node", "copies", F.explode("bands").alias("band"))
    groups = by_band.groupBy("band").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"),
        F.max(F.struct("copies", (-F.col("node")).alias("first"))).alias("c")).filter("lo < hi")
    # first round: the most copied node of each group is its centre
    members = stored(by_band.drop("copies").join(
        groups.select("band", (-F.col("c.first")).alias("centre")), "band"), "members")
    pairs = members.filter("node <> centre").select(
        F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    # each round's likely pairs are a folder of their own, and all folders are one scan
    tested = [scratch_path(docs.sparkSession, "likely")]
    _likely_pairs(pairs, bits, percent).write.parquet(tested[0])
    read = docs.sparkSession.read.schema(pairs.schema).parquet
    labels = components(_confirmed(read(*tested), source, size, percent))
    members = members.filter("node <> centre").drop("centre")
    half = F.shiftright("side_a.band", 32).cast("int")
    fan, texts = FAN, source
    while True:
        named = (members.join(labels, "node", "left")
                 .select("band", "node", F.coalesce("label", "node").alias("label")))
        # what is not in a group's commonest component so far: only pairs with such an end are left to compare
        shares = named.groupBy("band", "label").agg(F.count("*").alias("members"))
        open_groups = (shares.groupBy("band").agg(
            F.sum("members").alias("size"), F.max(F.struct("members", "label")).alias("most")).filter("size > most.members")
            .select("band", "size", (F.col("size") - F.col("most.members")).alias("rest"), F.col("most.label").alias("common")))
        named = stored(named.join(open_groups, "band"), "open")
        largest, rest = named.agg(F.max("size"), F.max("rest")).first()
        if largest is None:
            break
        last = rest <= WIDE * fan
        if fan == FAN:
            # rounds only lose members, so the texts and signatures of these serve all later ones; written first, as above
            left = stored(named.select("node").distinct(), "left")
            if not last:
                texts = stored(texts.join(left, "node", "left_semi"), "texts")
            nodes = stored(nodes.join(left, "node", "left_semi"), "nodes")
            # halves of the band hashes tell bands of one place apart well enough
            bits = signed_nodes(nodes, percent, F.transform("bands", lambda x: F.shiftright(x, 32).cast("int")).alias("bands"))
        outside = (F.col("label") != F.col("common")).alias("centre")
        if last:
            named = named.select("band", "node", "label", "size", outside)
        else:
            whole = F.col("rest") <= WIDE * fan
            wide = named.filter(~whole)
            first = (wide.groupBy("band", F.pmod(F.xxhash64("node", F.lit(fan)), F.lit(fan)).alias("slot"))
                     .agg(F.min("node").alias("node")).select("band", "node", F.lit(True).alias("first")))
            # written, since the pairs read it from both sides and the next round once more
            named = stored(named.filter(whole).select("band", "node", "label", "size", outside).unionByName(
                wide.join(first, ["band", "node"], "left")
                .select("band", "node", "label", "size", F.col("first").isNotNull().alias("centre"))), "marked")
        centres = named.filter("centre")
        # two centres meet once
        meet = ((F.col("side_a.band") == F.col("side_b.band")) & (F.col("side_a.label") != F.col("side_b.label"))
                & (~F.col("side_b.centre") | (F.col("side_a.node") < F.col("side_b.node"))))
        ends = [F.least("side_a.node", "side_b.node").alias("a"), F.greatest("side_a.node", "side_b.node").alias("b")]
        # the few pairs of a small group are named by ids, and signatures join the distinct ones
        few = F.col("size") <= SMALL
        a, b = centres.filter(few).alias("side_a"), named.filter(few).alias("side_b")
        pairs = _likely_pairs(a.join(b, meet).select(*ends).distinct(), bits.drop("bands"), percent)
        if largest > SMALL:
            # in a large group signatures come to the members, and a pair counts in the first of the bands it shares;
            # a member is in one block of its group and a centre in all of them, so no task gets a whole large group
            blocks = F.ceil(F.col("size") / BLOCK)
            of_a, of_b = F.explode(F.sequence(F.lit(0), blocks - 1)), F.pmod(F.xxhash64("node"), blocks)
            a, b = (side.filter(~few).join(bits, "node").withColumn("block", block)
                    .repartition("band", "block").alias(name)
                    for side, block, name in ((centres, of_a, "side_a"), (named, of_b, "side_b")))
            met = a.join(b, meet & (F.col("side_a.block") == F.col("side_b.block")) & likely("side_a", "side_b", percent)
                         & (F.array_intersect("side_a.bands", "side_b.bands")[0] == half)).select(*ends)
            pairs = pairs.union(met).distinct()
        fresh = scratch_path(docs.sparkSession, "likely")
        pairs.join(read(*tested), ["a", "b"], "left_anti").write.parquet(fresh)
        tested.append(fresh)
        labels = relabelled(labels, _confirmed(read(fresh), texts, size, percent))
        if last:
            break
        members = named.filter("not centre").select("band", "node")
        fan *= FAN
    return _answer(seen, classes, labels)


def _answer(seen: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    rows = seen.select("node", "n", "d1", "d2")
    named = classes.select("d1", "d2", "n", F.col("node").alias("class_node")).join(
        labels.select(F.col("node").alias("class_node"), "label"), "class_node", "left")
    named = named.select("d1", "d2", "n", F.coalesce("label", "class_node").alias("component"))
    found = rows.join(named, ["d1", "d2", "n"], "left")
    linked = (F.col("n") > 0) & F.col("node").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("node"))
    return found.select(
        F.col("node").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("node") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those whose id is the component's.

    Rows that share that id are all kept or all dropped, so ids should be unique.
    """
    gone = classify(docs, text, doc_id, size, percent).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
