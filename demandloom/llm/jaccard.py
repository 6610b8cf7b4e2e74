"""Exact Jaccard join by pivots: regions around pivots, windows by the triangle inequality, recursion.

A document's set is its distinct shingles of `width` words (A-Z as a-z); with fewer words, the whole
sequence is its one shingle; without words the set is empty and links with nothing. Two documents
link when 100 * intersection >= percent * union, that is, at a Jaccard distance of at most
r = 1 - percent / 100. That distance is a metric.

Documents with one and the same set are one point, so copies cost nothing. At a distance below 1 two
sets share a shingle, and with shingles in one fixed order, rare ones first, linked sets share one
within the first (1 - t) n + 1 of either: the points that have such a shingle in common are a first
region, and every linked pair lies together in one. Sizes of linked sets differ by a factor of at most
1/t: regions are cut by classes of size, each with the next smaller one's points as its boundary. A
region's pivot is the one of its points whose rarest shingles are the most common ones: of a crowd of near copies
that is the least edited, which most others are linked with. The choice changes no result:

* every point of a region is held against its pivot by sketches first. A sketch has two bits or more a
  shingle, each the parity of the shingles in its hash class; sketches differ in no more bits than
  their sets in shingles. A point whose sketch is too far away is further than r from the pivot. The
  others are measured on the full sets: those within r are linked with the pivot, and so are in one
  component with each other; no pair of them is looked at;
* the numbers of differing bits obey the triangle inequality, too: those of two linked points to one pivot
  differ by no more than the shingles that linked sets of the region's sizes can differ in. The
  region is cut into shells of that width, and each shell takes the points of the next inner one as
  its boundary: a linked pair is together in the outer one's shell;
* regions of the very same points are looked at once. A shell whose points are already in one component is done. Each other one is a region of the next
  round, without the pivot, and takes a pivot of its own from its inner points.

Regions with the same pivot measure a point once. After ROUNDS rounds, what is left is compared
within its shells, pair by pair, by sketch inside the join and then exactly: only pairs that pass the windows of all their
pivots, of sets not yet in one component, are left there. Nothing is capped.

The measured pairs bring both full sets together by shuffle; a pivot with many points is dealt out
over as many copies of its set. Points and links go through written tables in the shared folder.

Rows that share a doc_id are one document with several sets: their components are one. Rows with a
null doc_id take part in nothing: component_id is null. Null texts are as empty ones; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes
from demandloom.llm.graph import components
from demandloom.llm.neardup import shingle_sets

#: counters that order shingles from rare to common; another number gives the same links
SLOTS = 1 << 16
#: rounds of pivots before what is left is compared directly
ROUNDS = 2
#: 64-bit numbers of a mask: a sketch folded to one length for all, looked at before the sketch
MASK = 8
#: points that meet one copy of a pivot's set
CROWD = 500
_SET = ["set_a", "set_b", "n_shingles"]


def _tallied(width: int):
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many documents' shingles fall into each of SLOTS hash classes, in this task."""
        counts = np.zeros(SLOTS, np.int64)
        for _, data, at in wordcodes.chunks(batches, "text"):
            values = np.concatenate([np.empty(0, np.uint64), *shingle_sets(data, at, width)])
            counts += np.bincount((values % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full])], ["slot", "n"])
    return tally


def _identity(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits that tell sets apart, and their sizes."""
    a = np.array([s.sum() for s in sets], np.uint64)
    b = np.array([np.bitwise_xor.reduce(wordcodes.mixed(s * np.uint64(0xD6E8FEB86659FD93))) if len(s) else 0 for s in sets], np.uint64)
    return [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.array([len(s) for s in sets], np.int64))]


def _listed(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint64), *values]).view(np.int64)))


def _sketch(values: np.ndarray) -> np.ndarray:
    """Parities of a set's hash classes, at least two classes a shingle, as 64-bit numbers."""
    bits = max(64, 1 << int(2 * len(values) - 1).bit_length()) if len(values) else 64
    odd = np.bincount((values >> np.uint64(24)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _mask(sketch: np.ndarray) -> np.ndarray:
    """The sketch with MASK numbers: parts of a longer one folded together, a shorter one filled up."""
    if len(sketch) < MASK:
        return np.concatenate([sketch, np.zeros(MASK - len(sketch), np.uint64)])
    return np.bitwise_xor.reduce(sketch.reshape(-1, MASK), axis=0)


def _rank(rare: np.ndarray, common: np.ndarray) -> int:
    """How common a set's rarest shingles are; the last bits are a hash, as equal ranks would give regions of the same points different pivots."""
    total = min(int(common[(rare % np.uint64(SLOTS)).astype(np.int64)].sum()), 1 << 42)
    return total << 20 | int(rare.sum(dtype=np.uint64) >> np.uint64(44))


def _pointed(width: int, percent: int, counts):
    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's set as a point: its identity, its rarest shingles, as many as two linked sets cannot both miss, and its sketch."""
        common = counts.value
        for batch, data, at in wordcodes.chunks(batches, "text"):
            sets = shingle_sets(data, at, width)
            first = []
            for s in sets:
                n = len(s) - -(-len(s) * percent // 100) + 1 if len(s) else 0
                first.append(s[np.lexsort((s, common[(s % np.uint64(SLOTS)).astype(np.int64)]))[:n]])
            sketches = [_sketch(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_identity(sets), pa.array([_rank(s, common) for s in first], pa.int64()),
                 _listed(first), _listed(sketches), _listed([_mask(s) for s in sketches])],
                ["doc_id", *_SET, "rank", "rare", "sketch", "mask"])
    return point


def _whole(width: int):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in wordcodes.chunks(batches, "text"):
            sets = shingle_sets(data, at, width)
            yield pa.RecordBatch.from_arrays([*_identity(sets), _listed(sets)], [*_SET, "shingles"])
    return whole


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b, crowd) with the sizes of intersection and union of their sets.

    b is a pivot of about `crowd` pairs: its set is copied for every CROWD of them.
    """
    copies = pairs.groupBy("b").agg(F.max("crowd").alias("crowd")).select(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("crowd") / CROWD))).alias("copy"))
    pivots = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")).join(copies.hint("merge"), "b")
    points = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.floor(F.col("crowd") / CROWD) + 1).alias("copy"))
    both = dealt.join(points.hint("merge"), "a").join(pivots.hint("merge"), ["b", "copy"])
    shared_ = F.size(F.array_intersect("sa", "sb")).cast("long")
    return both.withColumn("both", shared_).select("a", "b", "both", (F.size("sa") + F.size("sb") - F.col("both")).alias("either"))


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * F.col("either")


def _apart(x: Column, y: Column) -> Column:
    """In how many bits two sketches differ; one twice as long as the other is folded to its length."""
    def folded(long: Column, short: Column) -> Column:
        half = F.size(short)
        return F.when(F.size(long) > half, F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half),
                                                      lambda a, b: a.bitwiseXOR(b))).otherwise(long)
    return F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b).cast("long")


def _sketched(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b, crowd) with `apart`, the bits in which their sketches differ, and if they may be linked."""
    for side in ("a", "b"):
        mine = points.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(mine.hint("merge"), side)
    both = F.col("n_a") + F.col("n_b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return (pairs.withColumn("apart", _apart(F.col("sketch_a"), F.col("sketch_b")))
            .withColumn("near", sizes & ((100 + percent) * F.col("apart") <= (100 - percent) * both))
            .select("a", "b", "crowd", "apart", "near"))


def _contracted(links: DataFrame, roots: DataFrame | None, folder: str) -> DataFrame:
    """(node, root) after more links: they join whole components of the roots found before."""
    if roots is None:
        return shared.stored_alone(components(links, folder), f"{folder}/out")
    ends = links
    for side in ("a", "b"):
        known = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        ends = ends.join(known.hint("merge"), side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    among = components(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), folder)
    moved = among.select(F.col("node").alias("root"), F.col("root").alias("moved"))
    out = roots.join(moved.hint("merge"), "root", "left").select("node", F.coalesce("moved", "root").alias("root"))
    return shared.stored_alone(out.unionByName(among.join(roots.hint("merge"), "node", "left_anti").select("node", "root")), f"{folder}/out")


def _classes(percent: int) -> Column:
    """Classes of set sizes: those of linked sets are equal or neighbours, and sizes of neighbours differ less than twofold each."""
    return F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(float(-np.log(percent / 100))) * (1 - 1e-9)).cast("long")


def _sized(members: DataFrame, percent: int) -> DataFrame:
    """members(region, node, n_shingles, rank) dealt into classes of size: each point is an upper one of its own
    class and a boundary point of the next."""
    spot = members.withColumn("class", _classes(percent)).withColumn("way", F.explode(F.array(F.lit(0), F.lit(1))))
    return spot.select(F.xxhash64("region", F.col("class") + F.col("way")).alias("region"), "node", "n_shingles", "rank",
                       F.lit(True).alias("inner"), (F.col("way") == 0).alias("upper"), F.col("node").alias("root"))


def _shells(members: DataFrame, percent: int) -> DataFrame:
    """members(region, node, n_shingles, rank, upper, apart, top, root) of sketched regions, dealt into shells.

    Each point is an inner one of its own shell and a boundary point of the next. Linked sets of up to
    `top` shingles differ in at most (1 - t) / (1 + t) * 2 top of them.
    """
    width = F.greatest(F.lit(1), F.expr(f"2 * {100 - percent} * top div {100 + percent}"))
    spot = members.withColumn("shell", F.floor(F.col("apart") / width)).withColumn("out", F.explode(F.array(F.lit(0), F.lit(1))))
    return spot.select(F.xxhash64("region", F.col("shell") + F.col("out")).alias("region"), "node", "n_shingles", "rank",
                       (F.col("out") == 0).alias("inner"), "upper", "root")


def _open_regions(cells: DataFrame) -> DataFrame:
    """Regions that may hold an unseen link: points of two components, and inner ones to choose a pivot from.

    Of regions that hold the same points in the same roles one is enough.
    """
    member = F.xxhash64("node", "inner", "upper")
    found = cells.groupBy("region").agg(
        F.count("*").alias("crowd"), F.min("root").alias("least"), F.max("root").alias("most"), F.max("upper").alias("has_upper"),
        F.max("n_shingles").alias("top"), F.max_by("node", F.when(F.col("inner"), F.col("rank"))).alias("pivot"),
        F.bit_xor(member).alias("x"), F.sum(F.xxhash64("node", "upper", "inner").cast("decimal(20,0)")).alias("s"))
    return (found.filter("least <> most AND pivot IS NOT NULL AND has_upper")
            .groupBy("crowd", "top", "pivot", "x", "s").agg(F.min("region").alias("region")).select("region", "crowd", "top", "pivot"))


def _left_over(cells: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs of each region that pass its windows, may be linked by their sketches and are not in one component."""
    sketched = cells.select("region", "node", "n_shingles", "inner", "upper", "root").join(
        points.select("node", "sketch", *[F.get("mask", F.lit(k)).alias(f"m{k}") for k in range(MASK)]).hint("merge"), "node")
    left, right = (sketched.select("region", *[F.col(c).alias(f"{c}_{side}") for c in sketched.columns if c != "region"]) for side in (1, 2))
    both = F.col("n_shingles_1") + F.col("n_shingles_2")
    sizes = (100 * F.least("n_shingles_1", "n_shingles_2") >= percent * F.greatest("n_shingles_1", "n_shingles_2"))
    # masks of two lengths of sketch differ in more than their sets; those of over MASK numbers never do
    masks = sum((F.bit_count(F.col(f"m{k}_1").bitwiseXOR(F.col(f"m{k}_2"))) for k in range(MASK)), F.lit(0))
    whole = (F.size("sketch_1") >= MASK) & (F.size("sketch_2") >= MASK)
    return (left.join(right.hint("merge"), "region")
            .filter((F.col("node_1") < F.col("node_2")) & (F.col("root_1") != F.col("root_2")) & sizes
                    & (F.col("inner_1") | F.col("inner_2")) & (F.col("upper_1") | F.col("upper_2"))
                    & (~whole | ((100 + percent) * masks <= (100 - percent) * both))
                    & ((100 + percent) * _apart(F.col("sketch_1"), F.col("sketch_2")) <= (100 - percent) * both))
            .select(F.col("node_2").alias("a"), F.col("node_1").alias("b")).distinct()
            .withColumn("crowd", F.lit(0).cast("long")))


def jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, component_id) of every row of docs(doc_id, text, ...), and the measured links.

    Links are (a, b, both, either) of the smallest documents of two sets, with the sizes of their
    intersection and union: with the membership of equal sets they make the components, and every
    pair within one of a pivot's regions follows from them.
    """
    if not 0 < percent < 100:
        raise ValueError("percent lies between 0 and 100")
    spark = docs.sparkSession
    folder = shared.workspace(spark, "jaccard")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tally = base.select("text").mapInArrow(_tallied(width), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[tally["slot"].to_numpy(np.int64)] = tally["n"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(counts)
    identity = "set_a long, set_b long, n_shingles long"
    rows = shared.stored_alone(base.mapInArrow(_pointed(width, percent, sent), f"doc_id long, {identity}, rank long, rare array<long>, sketch array<long>, mask array<long>"), f"{folder}/rows")
    named = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")

    # one point for each distinct set, numbered as written
    points = named.groupBy(*_SET).agg(F.min("doc_id").alias("first"), F.first("rank").alias("rank"), F.first("rare").alias("rare"), F.first("sketch").alias("sketch"), F.first("mask").alias("mask"))
    points = shared.stored_alone(points.withColumn("node", F.monotonically_increasing_id()), f"{folder}/points")
    member = (rows.drop("rank", "rare", "sketch", "mask").join(points.select(*_SET, "node").hint("merge"), _SET, "left")
              .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")))
    member = shared.stored_alone(member, f"{folder}/member")
    repeats = not named.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    shared.dropped(spark, f"{folder}/rows")
    several = (member.filter("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("a"))
               .filter("a <> b").select("a", "b"))

    # first regions: points that share one of their rarest shingles
    shingled = points.select(F.explode("rare").alias("region"), "node", "n_shingles", "rank")
    met = shingled.groupBy("region").agg(F.count("*").alias("n")).filter("n > 1").select("region")
    dealt = shared.stored_alone(_sized(shingled.join(met.hint("merge"), "region"), percent), f"{folder}/dealt-0")
    cells = shared.stored_alone(dealt.join(_open_regions(dealt).hint("merge"), "region"), f"{folder}/cells-0")
    shared.dropped(spark, f"{folder}/dealt-0")

    def measured(pairs: DataFrame, k: int) -> DataFrame:
        """The pairs that may be linked, measured on their full sets, which are made anew from their texts."""
        ends = shared.stored_alone(pairs.filter("near").select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{folder}/ends-{k}")
        wanted = shared.stored_alone(points.drop("rank", "rare", "sketch", "mask").join(ends.hint("merge"), "node", "left_semi"), f"{folder}/wanted-{k}")
        texts = base.join(wanted.select(F.col("first").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
        whole = texts.select("text").mapInArrow(_whole(width), f"{identity}, shingles array<long>")
        if repeats:
            whole = whole.groupBy(*_SET).agg(F.first("shingles").alias("shingles"))
        sets = whole.join(wanted.select(*_SET, "node").hint("merge"), _SET).select("node", "shingles")
        sets = shared.stored_alone(sets, f"{folder}/sets-{k}")
        out = shared.stored_alone(_measured(pairs.filter("near"), sets), f"{folder}/measured-{k}")
        shared.dropped(spark, f"{folder}/sets-{k}")
        return out

    roots, seen, links, k = None, None, None, 0
    while True:
        star = (cells.filter("node <> pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b"))
                .agg(F.max("crowd").alias("crowd")))
        if seen is not None:
            star = star.join(seen.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        now = shared.stored_alone(_sketched(star, points, percent), f"{folder}/sketched-{k}")
        seen = now if seen is None else seen.unionByName(now)
        found = measured(now, k).filter(_linked(percent))
        links = found if links is None else links.unionByName(found)
        edges = found.select("a", "b")
        if not k or not edges.isEmpty():
            roots = _contracted(edges.unionByName(several) if repeats and not k else edges, roots, f"{folder}/roots-{k}")
        placed = cells.drop("root").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        # regions in one component are done
        split = placed.groupBy("region").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("region")
        known = (placed.join(split.hint("merge"), "region", "left_semi")
                 .join(seen.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "apart").hint("merge"), ["node", "pivot"]))
        k += 1
        dealt = shared.stored_alone(_shells(known, percent), f"{folder}/dealt-{k}")
        cells = shared.stored_alone(dealt.join(_open_regions(dealt).hint("merge"), "region"), f"{folder}/cells-{k}")
        if k >= rounds or cells.isEmpty():
            break
    rest = _left_over(cells, points, percent).join(seen.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    late = shared.stored_alone(_sketched(rest, points, percent).filter("near"), f"{folder}/sketched-{k}")
    found = measured(late, k).filter(_linked(percent))
    links = links.unionByName(found)
    if not found.isEmpty():
        roots = _contracted(found.select("a", "b"), roots, f"{folder}/roots-{k}")

    placed = points.select("node", "first").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    label = placed.join(label.hint("merge"), "root").select("node", "component_id")
    out = member.join(label.hint("merge"), "node", "left").select("doc_id", "n_shingles", "component_id")
    if repeats:
        one = out.groupBy("doc_id").agg(F.min("component_id").alias("component_id")).filter("doc_id IS NOT NULL")
        out = out.drop("component_id").join(one, "doc_id", "left")
    names = points.select(F.col("node"), F.col("first"))
    for side in ("a", "b"):
        links = links.join(names.withColumnsRenamed({"node": side, "first": f"first_{side}"}).hint("merge"), side)
    links = links.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"), "both", "either")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), links


def joined(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return jaccard_join(docs, width, percent)[0]
