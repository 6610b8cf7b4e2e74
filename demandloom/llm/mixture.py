"""Mixing sources to target sizes by balanced sampling with the cube method.

Every document of a source starts with the same expected number of copies, target / source size.
Its whole part is certain; the rest is an inclusion probability. The flight phase takes three open
documents of a source at a time and moves their probabilities along the one direction that leaves
both the documents' and the words' total unchanged, until one becomes 0 or 1; which end is reached
is drawn so that each expectation stays. Two documents of a source stay open in each block; those
of many blocks meet in the next round, until one group is left for each source. Long documents go
first, so that short ones are left for the landing, which
gives up the words' balance for the last two, and the documents' for the last one.

Blocks and draws depend on a seeded hash of the rows alone, so runs agree. Only hash, size and
source of a row travel. Null texts have no words. Equal rows are separate documents; which of them
is taken twice does not matter. Sources of no words have target 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: documents of a block, and blocks that meet in the next round
BLOCK, FAN = 4096, 512
SEED = 23


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in wordcodes.chunks(batches, "text"):
        words = wordcodes.Words(data, at, wordcodes.VISIBLE)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), batch.column("source"), pa.array(words.per_row(), pa.int64())],
            ["rid", "doc_id", "source", "size"])


def targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """by_source(source, source_size) with target: weights in code point order of the sources, null
    last, share `share` of all sizes; no target is above `most` times its source, and what is cut
    there goes to the others by weight. One row a source."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(order, F.lit(len(weights))).cast("int") + 1)
    rows = (by_source.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
            .withColumn("level", F.col("most") / F.col("weight")))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    below, here_up = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * float(share) - F.coalesce(F.sum("most").over(below), F.lit(0.0))
    rows = rows.withColumn("rate", left / F.sum("weight").over(here_up))
    # the first source, by level, that its share does not fill sets the rate of all from there on
    rate = F.min(F.when(F.col("rate") <= F.col("level"), F.struct("level", "rate"))).over(whole)["rate"]
    return (rows.withColumn("rate", F.coalesce(rate, F.max("level").over(whole)))
            .select("source", "source_size", F.least("most", F.col("weight") * F.col("rate")).alias("target")))


def _fly(open_: list, probability: list, size: list, out: list, draw) -> list:
    """Moves open units three at a time; returns the (at most two) that stay open."""
    pool: list = []
    for unit in open_:
        pool.append(unit)
        while len(pool) == 3:
            a, b, c = pool
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if not (u[0] or u[1] or u[2]):
                u = (1, -1, 0)
            up = down = float("inf")
            for k, v in zip(pool, u):
                if v:
                    p = probability[k]
                    up = min(up, (1 - p) / v if v > 0 else -p / v)
                    down = min(down, p / v if v > 0 else (p - 1) / v)
            step = up if draw() * (up + down) < down else -down
            for k, v in zip(pool, u):
                probability[k] += step * v
            pool = _settled(pool, probability, out)
    return pool


def _settled(pool: list, probability: list, out: list) -> list:
    stay = []
    for k in pool:
        if probability[k] < 1e-9:
            out[k] = 0
        elif probability[k] > 1 - 1e-9:
            out[k] = 1
        else:
            stay.append(k)
    return stay


def _land(pool: list, probability: list, out: list, draw) -> None:
    if len(pool) == 2:
        a, b = pool
        both = probability[a] + probability[b]
        first = draw() * both < probability[a]
        probability[a], probability[b] = ((min(1.0, both), max(0.0, both - 1)) if first else (max(0.0, both - 1), min(1.0, both)))
        pool = _settled(pool, probability, out)
    for k in pool:
        out[k] = int(draw() < probability[k])


def _flight(seed: int, land: bool):
    def flight(table: pa.Table) -> pa.Table:
        table = table.sort_by([("source", "ascending"), ("size", "descending"), ("draw", "ascending")])
        size, source = table.column("size").to_pylist(), table.column("source").to_pylist()
        probability, out = table.column("p").to_pylist(), [None] * table.num_rows
        begin = 0
        while begin < len(source):
            end = begin
            while end < len(source) and source[end] == source[begin]:
                end += 1
            name = "" if source[begin] is None else f"s{source[begin]}"
            rng = np.random.default_rng([seed, zlib.crc32(name.encode()), table.column("block")[begin].as_py()])
            draw = iter(rng.random(2 * (end - begin) + 4).tolist()).__next__
            pool = _fly(_settled(list(range(begin, end)), probability, out), probability, size, out, draw)
            if land:
                _land(pool, probability, out, draw)
            begin = end
        columns = {"rid": table.column("rid"), "doc_id": table.column("doc_id"), "source": table.column("source"), "size": table.column("size"),
                   "block": table.column("block"), "draw": table.column("draw"),
                   "p": pa.array(probability, pa.float64()), "included": pa.array(out, pa.int32())}
        return pa.table(columns)
    return flight


FLIGHT = "rid string, doc_id long, source string, size long, block long, draw long, p double, included int"


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """rid, doc_id, source, size, source_size, target and copies (0 to `most`) of every document.

    rid is a hash of the whole row.
    """
    spark = docs.sparkSession
    folder = shared.workspace(spark, "mixture")
    base = docs.select(row_id(docs).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    sized = shared.stored(base.mapInArrow(_count_words, "rid string, doc_id long, source string, size long"), f"{folder}/sized")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    aims = shared.stored(targets(by_source, weights, share, most), f"{folder}/targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = aims.select(F.col("source").alias("source_"), "source_size", "target", F.least(F.lit(float(most)), ratio).alias("ratio"))
    known = F.col("source").eqNullSafe(F.col("source_"))
    rows = sized.join(rates, known).drop("source_").withColumn("certain", F.floor("ratio").cast("int"))

    blocks = max(1, -(-sized.count() // BLOCK))
    draw = F.xxhash64("rid", F.lit(seed))
    at = (rows.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(seed + 1)), F.lit(blocks)))
          .select("rid", "doc_id", "source", "size", "block", draw.alias("draw"), (F.col("ratio") - F.col("certain")).alias("p"), F.lit(None).cast("int").alias("included")))
    done, turn, group = None, 0, ["block"]
    while True:
        last = blocks == 1
        flown = shared.stored(at.groupBy(*group).applyInArrow(_flight(seed + turn, last), FLIGHT), f"{folder}/flight-{turn}")
        settled = flown.filter("included IS NOT NULL").select("rid", "doc_id", "source", "size", "included")
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        turn += 1
        blocks = -(-blocks // FAN)
        at, group = flown.filter("included IS NULL").withColumn("block", F.floor(F.col("block") / FAN)), ["block", "source"]
    return (done.join(rates, known).drop("source_")
            .select("rid", "doc_id", "source", "size", "source_size", "target", (F.floor("ratio").cast("int") + F.col("included")).alias("copies")))


def row_id(docs: DataFrame) -> Column:
    """128 bits of a row: two hashes of all its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *columns)), 16, "0") for k in (0, 1)])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: rows left out, once, or repeated."""
    (rid,) = shared.fresh(docs, "rid")
    (copies,) = shared.fresh(docs, "copies")
    taken = mix(docs, **options).groupBy(F.col("rid").alias(rid)).agg(F.sum("copies").cast("int").alias(copies)).filter(F.col(copies) > 0)
    return (docs.withColumn(rid, row_id(docs)).dropDuplicates([rid]).join(taken, rid)
            .withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies))))
            .select(*[f"`{c}`" for c in docs.columns]))
