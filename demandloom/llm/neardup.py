"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

A document's set is its distinct shingles of `width` words (A-Z as a-z); with fewer words, the whole
sequence is its one shingle; without words the set is empty and links with nothing. Two documents
are linked when their sets' similarity reaches the threshold, which every link is checked for on
the full sets.

One pass hashes each shingle once. The upper part of the hash picks one of ROWS x BANDS bins, the
smallest hash in a bin is its value, and an empty bin borrows from the first non-empty one in a
fixed random order of its own (optimal densification). ROWS values make a band; documents equal in a
band share a bucket. At similarity 0.8 a pair shares none of 42 bands of 6 with probability 3e-6.

Candidates of a bucket are not its pairs but a star: each member with the bucket's smallest one. A
star misses links between members that are not linked with its centre. So the documents of buckets
that the stars leave in several components are joined once more, exactly, on their rarest shingles
(see `_rare_first`). Documents with one and the same set are one node throughout, so copies cost
nothing. All joins go by shuffle, since both sides grow with the input.

Rows that share a doc_id are one document with several sets: their components are one. Rows with a
null doc_id take part in nothing: component_id is null and they are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes
from demandloom.llm.graph import components

ROWS, BANDS = 6, 42
BINS = ROWS * BANDS
#: counters that order shingles from rare to common, whatever the input
SLOTS = 1 << 16
#: numbers of 64 parity bits that go with a set
MASKS = 8
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words = wordcodes.Words(data, at, wordcodes.VISIBLE)
    codes = words.codes(fold=True)
    hashes = np.zeros(max(0, len(codes) - width + 1), np.uint64)
    for i in range(width):
        hashes = hashes * np.uint64(_ODD[0]) + codes[i:len(codes) - width + 1 + i] if len(hashes) else hashes
    hashes = wordcodes.mixed(hashes)
    out = []
    for first, end in zip(words.of[:-1].tolist(), words.of[1:].tolist()):
        n = end - first
        if n >= width:
            out.append(np.unique(hashes[first:end - width + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for code in codes[first:end]:
                    whole = whole * np.uint64(_ODD[1]) + code
            out.append(wordcodes.mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _ranks() -> np.ndarray:
    """ranks[i, j]: how late bin i would borrow from bin j."""
    order = np.random.default_rng(11).permuted(np.tile(np.arange(BINS, dtype=np.int16), (BINS, 1)), axis=1)
    return np.argsort(order, axis=1).astype(np.int16)


def signature(values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One value for each bin of a sorted, non-empty set of hashes."""
    bins = (((values >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    full = bins[first]
    out = np.zeros(BINS, np.uint64)
    out[full] = values[first]
    if len(full) < BINS:
        empty = np.ones(BINS, bool)
        empty[full] = False
        lender = full[ranks[np.ix_(empty, full)].argmin(axis=1)]
        out[empty] = out[lender]
    return out


def _band_codes(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(-1, BANDS, ROWS)
    code = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        code = wordcodes.mixed(code * np.uint64(_ODD[2]) + parts[:, :, i])
    return code


SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sign(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks()
        for batch, data, at in wordcodes.chunks(batches, "text"):
            sets = shingle_sets(data, at, width)
            sizes = np.array([len(s) for s in sets], np.int64)
            signed = [signature(s, ranks) for s in sets if len(s)]
            bands = _band_codes(np.array(signed, np.uint64).reshape(-1, BINS)).view(np.int64)
            ends = np.concatenate([[0], np.cumsum((sizes > 0) * BANDS)]).astype(np.int32)
            a = np.array([s.sum() if len(s) else 0 for s in sets], np.uint64)
            b = np.array([np.bitwise_xor.reduce(wordcodes.mixed(s * np.uint64(_ODD[3]))) if len(s) else 0 for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel()))],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return sign


def _write_sets(width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in wordcodes.chunks(batches, "text"):
            sets = shingle_sets(data, at, width)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["node", "shingles"])
    return write


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) with the sizes of intersection and union of their full sets.

    Sizes alone rule out a pair whose smaller set is under half of the larger one.
    """
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (both.withColumn("common", common)
            .withColumn("either", F.size("sa") + F.size("sb") - F.col("common"))
            .select("a", "b", "common", "either", (100 * F.col("common") >= percent * F.col("either")).alias("linked")))


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs(doc_id, text, ...)."""
    spark = docs.sparkSession
    folder = shared.workspace(spark, "neardup")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = shared.stored(base.mapInArrow(_sign(width), SIGNED), f"{folder}/signed")

    # one node for each distinct set, named by its smallest document
    named = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = shared.stored(
        named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")),
        f"{folder}/nodes")
    member = (signed.select("doc_id", "n_shingles", "set_a", "set_b")
              .join(nodes.select("set_a", "set_b", "n_shingles", "node").hint("merge"), ["set_a", "set_b", "n_shingles"], "left")
              .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")))
    repeats = not named.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    several = (member.filter("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
               .filter("a <> b").select("a", "b"))

    # buckets of two nodes or more
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared_buckets = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    open_ = shared.stored(banded.join(shared_buckets.hint("merge"), "bucket"), f"{folder}/buckets-0")

    # the full sets of the documents that share a bucket
    wanted = open_.select("node").distinct()
    distinct_docs = base.join(wanted.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left_semi")
    sets = distinct_docs.select(F.col("doc_id").alias("node"), "text").mapInArrow(_write_sets(width), "node long, shingles array<long>")
    sets = shared.stored(sets, f"{folder}/sets")

    # stars: one hub for each node first, the other buckets' hubs only where that has not joined them
    hub = open_.groupBy("bucket").agg(F.min("node").alias("b"))
    star = shared.stored(open_.join(hub.hint("merge"), "bucket").filter("node <> b").select(F.col("node").alias("a"), "b").distinct(), f"{folder}/star")
    first = star.groupBy("a").agg(F.min("b").alias("b"))
    checked = shared.stored(_checked(first, sets, percent), f"{folder}/checked-0")
    to_hub = checked.filter("linked").select(F.col("a").alias("node"), F.col("b").alias("root"))
    others = (_with_roots(star.join(checked.select("a", "b").hint("merge"), ["a", "b"], "left_anti"), to_hub)
              .filter("root_a <> root_b").select("a", "b"))
    checked = checked.unionByName(shared.stored(_checked(others, sets, percent), f"{folder}/checked-1"))
    links = checked.filter("linked").select("a", "b")
    roots = shared.stored(components(links.unionByName(several) if repeats else links, f"{folder}/roots-0"), f"{folder}/roots-0/out")

    # the rest, exactly: documents of buckets that the stars left in several components
    placed = (open_.join(roots.hint("merge"), "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")))
    split = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("bucket")
    rest = shared.stored(placed.join(split.hint("merge"), "bucket", "left_semi").select("node", "root").distinct(), f"{folder}/rest")
    pairs = _rare_first(rest, sets, percent).join(checked.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    late = shared.stored(_checked(pairs, sets, percent), f"{folder}/checked-2").filter("linked").select("a", "b")
    # late links join whole components: their roots are the nodes of a small graph
    among = components(_with_roots(late, roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), f"{folder}/roots-1")
    moved = among.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    lone = among.join(roots.hint("merge"), "node", "left_anti")
    roots = (roots.join(moved.hint("merge"), "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
             .unionByName(lone.select("node", "root")))
    roots = shared.stored(roots, f"{folder}/roots-1/out")
    out = member.join(roots.hint("merge"), "node", "left")
    found = F.coalesce("root", "node")
    label = out.groupBy("doc_id").agg(F.min(found).alias("root"))
    if not repeats:
        out = out.select("doc_id", "n_shingles", F.coalesce(found, "doc_id").alias("component_id"))
    else:
        out = (member.join(label.filter("doc_id IS NOT NULL"), "doc_id", "left")
               .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def _with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """root_a and root_b beside a and b; a node without links is its own root."""
    for side in ("a", "b"):
        pairs = (pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")).hint("merge"), side, "left")
                 .withColumn(f"root_{side}", F.coalesce(f"root_{side}", side)))
    return pairs


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the shingles of each of SLOTS hash classes occur in this task."""
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        values = batch.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        counts += np.bincount((values % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    full = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full])], ["slot", "n"])


def _parity(values: np.ndarray) -> np.ndarray:
    """MASKS numbers whose bits tell, of each of 64 * MASKS hash classes, if the set has an odd number in it."""
    odd = np.bincount((values.view(np.uint64) >> np.uint64(32)).astype(np.int64) % (64 * MASKS), minlength=64 * MASKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(counts, percent: int):
    """The rarest shingles of each set: as many as two linked sets cannot both miss."""
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = counts.value
        for batch in batches:
            column = batch.column("shingles")
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(ends).astype(np.int64)
            probe = sizes - -(-sizes * percent // 100) + 1
            index = sizes - -(-sizes * 2 * percent // (100 + percent)) + 1
            which, place, masks = [], [], []
            for start, size, n in zip(ends[:-1].tolist(), sizes.tolist(), probe.tolist()):
                one = values[start:start + size]
                slot = (one.view(np.uint64) % np.uint64(SLOTS)).astype(np.int64)
                which.append(one[np.lexsort((one, rare[slot]))[:n]])
                place.append(np.arange(n, dtype=np.int32))
                masks.append(_parity(one))
            if which:
                at = np.concatenate(place)
                bits = np.repeat(np.array(masks), probe, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(which)), pa.array(at), pa.array(at < np.repeat(index, probe)),
                     pa.array(np.repeat(batch.column("node").to_numpy(), probe)), pa.array(np.repeat(batch.column("root").to_numpy(), probe)),
                     pa.array(np.repeat(sizes, probe)), *[pa.array(bits[:, k].copy()) for k in range(MASKS)]],
                    ["shingle", "place", "indexed", "node", "root", "size", *[f"m{k}" for k in range(MASKS)]])
    return prefixes


def _rare_first(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of `rest` in different components that can reach the threshold, and few others.

    With shingles in one fixed order, rarest first, two sets of a similarity t share one within the
    first (1 - t) m + 1 of the larger and the first n - 2 t n / (1 + t) + 1 of the smaller one; a
    first shared shingle at places i and j leaves an overlap of at most min(m - i, n - j), which
    must reach t / (1 + t) (m + n). Hash classes in which one set has an odd number of shingles and
    the other an even one each hold a shingle that the sets do not share; (1 - t) / (1 + t) (m + n)
    such shingles are too many. None of these rules drops a linked pair. A passage that thousands of
    documents share is not rare, so it does not bring them together. The order comes from SLOTS
    counters over these sets; which order it is does not change the result.
    """
    mine = sets.join(rest.hint("merge"), "node")
    tally = mine.select("shingles").mapInArrow(_tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[tally["slot"].to_numpy(np.int64)] = tally["n"].to_numpy(np.int64)
    shared_counts = rest.sparkSession.sparkContext.broadcast(counts)
    masks = [f"m{k}" for k in range(MASKS)]
    rows = mine.mapInArrow(_prefixes(shared_counts, percent), "shingle long, place int, indexed boolean, node long, root long, size long, "
                           + ", ".join(f"{m} long" for m in masks))
    columns = ("place", "node", "root", "size", *masks)
    left = rows.select("shingle", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = rows.filter("indexed").select("shingle", *[F.col(c).alias(f"{c}_b") for c in columns])
    most = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    both = F.col("size_a") + F.col("size_b")
    odd = sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in masks), F.lit(0))
    return (left.join(right.hint("merge"), "shingle")
            .filter((F.struct("size_a", "node_a") > F.struct(F.col("size_b").alias("size_a"), F.col("node_b").alias("node_a")))
                    & (F.col("root_a") != F.col("root_b"))
                    & ((100 + percent) * most >= percent * both)
                    & (100 * F.col("size_b") >= percent * F.col("size_a"))
                    & ((100 + percent) * odd <= (100 - percent) * both))
            .select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct())
