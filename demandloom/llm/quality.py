"""Quality classifier: interpolated modified Kneser-Ney over characters, one model a language.

Trusted text is that of the documents labelled good (quality 1, toxic 0). A seeded hash of doc_id
puts every fifth of them aside for the threshold; in all others the ORDER-grams are counted, and every lower order counts the distinct grams that extend it to the left (continuations). Discounts for counts 1, 2 and more come from the counts of counts.
Every character is a symbol of its own: a UTF-16 unit, of which rare characters have two, so that a
gram is 64 bits; one that is no character stands before the text. Each language has its own model
and threshold, however little trusted text it has.

Documents are dealt into blocks of about BLOCK characters by a hash. The distinct grams of each
block are written, and the probability of each gram is put together by joins of count tables that
are sharded by gram: its own discounted count, and its context's remaining weight times the shorter
gram's probability, down to the uniform one. The grams of the blocks meet the finished table in a
join by gram (a gram comes once a block, however often it occurs) and go back to the block's
documents. All these tables grow with the input; none passes through the driver or is broadcast. Texts cross the network twice, to be counted
and to be scored, each compressed by itself; a table is deleted when the next one stands.

A document's perplexity is that of its characters. One above the QUANTILE of the held-out trusted
documents' perplexities in its language is rejected; of under 200 such documents that is the largest. Null and empty texts have no perplexity and are kept, as
are all documents of a language without counted or without held-out trusted text. A null language is one of its own. Documents labelled
several times are trusted if no label speaks against it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm import shared, wordcodes

BITS, ORDER = 16, 4
SYMBOLS = 1 << BITS
#: share of trusted documents that may be rejected
QUANTILE = 0.995
#: labels sent to every task: 8 bytes each; with more the labels are joined by shuffle
BROADCAST_LABELS = 2_000_000
#: characters of a block; its documents and their grams are in one task's memory
BLOCK = 8_000_000
#: one in FOLDS trusted documents sets the threshold; the others are counted
FOLDS, SEED = 5, 31
_START = 0xFFFF


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-16 units of all texts, and where each row begins."""
    rows = [(t or "").encode("utf-16-le", "surrogatepass") for t in texts.to_pylist()]
    at = np.concatenate([[0], np.cumsum([len(r) // 2 for r in rows])]).astype(np.int64)
    return np.frombuffer(b"".join(rows), np.uint16), at


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each unit, as a number, and where each row begins."""
    units, at = _units(texts)
    code = units.astype(np.uint64)
    left = np.arange(len(units)) - np.repeat(at[:-1], np.diff(at))
    for back in range(1, ORDER):
        before = np.full(len(units), _START, np.uint64)
        before[back:] = units[:-back]
        before[left < back] = _START
        code |= before << np.uint64(BITS * back)
    return code.view(np.int64), at


def _packed(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each text compressed, for the way through a shuffle."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch, _, _ in wordcodes.chunks(batches, text):
            at = batch.schema.get_field_index(text)
            small = pa.array([None if t is None else squeeze(t.encode()) for t in batch.column(at).to_pylist()], pa.binary())
            yield batch.set_column(at, text, small)

    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == text else f.dataType) for f in rows.schema])
    return rows.mapInArrow(pack, schema)


def _unpacked(block: pa.Table, text: str = "text") -> pa.Table:
    stretch = zstandard.ZstdDecompressor().decompress
    # some hundreds at a time, so that few texts are Python objects at once
    parts = [pa.array([None if t is None else stretch(t) for t in part.to_pylist()], pa.binary()).cast(pa.string())
             for start in range(0, block.num_rows, 256) for part in (block.column(text).slice(start, 256),)]
    whole = pa.chunked_array(parts, pa.string())
    return block.set_column(block.schema.get_field_index(text), text, whole)


def _merged(parts: list) -> list:
    """Parts (codes, counts) as one, with each code once."""
    codes, which = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return [(codes, np.bincount(which, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64))]


def _block_grams(block: pa.Table) -> pa.Table:
    """Grams of a block's documents: how often in text to count, and (with 0) that they occur at all."""
    total: dict = {}
    block = _unpacked(block)
    for batch, _, _ in wordcodes.chunks(block.to_batches(), "text"):
        code, at = _grams(batch.column("text"))
        names = np.array(batch.column("lang").to_pylist(), object)
        counted = batch.column("counted").to_numpy(zero_copy_only=False).astype(bool)
        for name in set(names.tolist()):
            parts = total.setdefault(name, [])
            for good in (False, True):
                seen, n = np.unique(code[np.repeat((names == name) & (counted == good), np.diff(at))], return_counts=True)
                parts.append((seen, n if good else np.zeros_like(n)))
            if sum(len(c) for c, _ in parts) > 1_000_000:
                total[name] = _merged(parts)
    found = [(name, *_merged(parts)[0]) for name, parts in total.items()]
    pa.default_memory_pool().release_unused()  # the worker goes on to other blocks
    number = block.column("block")[0].as_py()
    return pa.table({
        "block": pa.array(np.full(sum(len(codes) for _, codes, _ in found), number, np.int64)),
        "lang": pa.array(np.repeat(np.array([name for name, _, _ in found], object), [len(codes) for _, codes, _ in found]), pa.string()),
        "code": pa.array(np.concatenate([np.empty(0, np.int64), *[codes for _, codes, _ in found]])),
        "n": pa.array(np.concatenate([np.empty(0, np.int64), *[n for _, _, n in found]])),
    })


def _context(code: str) -> Column:
    """The gram without its last symbol."""
    return F.shiftrightunsigned(code, BITS)


def _last(code: str, k: int) -> Column:
    """The last k symbols of a gram; k is under ORDER."""
    return F.col(code).bitwiseAND(F.lit((1 << BITS * k) - 1))


def _discounted(counts: DataFrame) -> DataFrame:
    """Rows (model, code, context, own, rest) of one order: discounted share of the code's context,
    and the weight that the discounts leave to the shorter gram there."""
    of_counts = counts.groupBy("model").agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(k: int, fall_back: float) -> Column:
        fitted = k - (k + 1) * y * F.try_divide(f"n{k + 1}", f"n{k}")
        return F.coalesce(F.when((fitted > 0) & (fitted < k), fitted), F.lit(fall_back))

    d = of_counts.select("model", *[discount(k, 0.5 + 0.25 * (k - 1)).alias(f"d{k}") for k in (1, 2, 3)])
    rows = counts.join(F.broadcast(d), "model").withColumn("context", _context("code"))
    taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.withColumn("taken", F.least(taken, F.col("n").cast("double")))
    contexts = rows.groupBy("model", "context").agg(F.sum("n").alias("total"), F.sum("taken").alias("taken_"))
    return rows.join(contexts, ["model", "context"]).select(
        "model", "code", "context", ((F.col("n") - F.col("taken")) / F.col("total")).alias("own"), (F.col("taken_") / F.col("total")).alias("rest"))


def probabilities(counts: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """(model, code, logp) of the wanted(model, code) grams, from counts(model, code, n)."""
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        orders[k] = orders[k + 1].groupBy("model", _last("code", k).alias("code")).agg(F.count("*").alias("n"))
    asked = {ORDER: wanted.distinct()}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = asked[k + 1].select("model", _last("code", k).alias("code")).distinct()
    shorter = None
    for k in range(1, ORDER + 1):
        model = shared.stored_alone(_discounted(orders[k]), f"{folder}/order-{k}")
        rest = model.select("model", "context", "rest").distinct()
        rows = (asked[k].withColumn("context", _context("code"))
                .join(model.select("model", "code", "own"), ["model", "code"], "left").join(rest, ["model", "context"], "left"))
        if shorter is None:
            low = F.lit(1.0 / SYMBOLS)
        else:
            rows = (rows.withColumn("tail", _last("code", k - 1))
                    .join(shorter.select("model", F.col("code").alias("tail"), F.col("p").alias("low")), ["model", "tail"]))
            low = F.col("low")
        p = F.coalesce("own", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * low
        shorter = shared.stored_alone(rows.select("model", "code", p.alias("p")), f"{folder}/p-{k}")
        for done in (f"{folder}/order-{k}", f"{folder}/p-{k - 1}"):
            shared.dropped(counts.sparkSession, done)
    return shorter.select("model", "code", F.log("p").alias("logp"))


def _score(keep: tuple[str, ...], text: str, lang: str, name: str):
    """A block's documents with their perplexity, from the block's rows (lang, code, logp)."""
    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        block = _unpacked(block, text)
        of, codes, logs = found.column("lang").to_numpy(), found.column("code").to_numpy(), found.column("logp").to_numpy()
        tables = {}
        for model in set(found.column("lang").unique().to_pylist()):
            mine = np.flatnonzero(of == model)
            mine = mine[np.argsort(codes[mine])]
            tables[model] = codes[mine], logs[mine]
        out = [np.empty(0)]
        for batch, _, _ in wordcodes.chunks(block.to_batches(), text):
            code, at = _grams(batch.column(text))
            names = np.array(batch.column(lang).to_pylist(), object)
            value = np.zeros(len(code))
            for model in set(names.tolist()) & set(tables):
                mine = np.flatnonzero(np.repeat(names == model, np.diff(at)))
                known, logp = tables[model]
                value[mine] = logp[np.searchsorted(known, code[mine])]
            sums = np.concatenate([[0.0], np.cumsum(value)])
            n = np.diff(at)
            out.append(np.where(n > 0, np.exp(-(sums[at[1:]] - sums[at[:-1]]) / np.maximum(n, 1)), np.nan))
        per = np.concatenate(out)
        pa.default_memory_pool().release_unused()
        return block.select(keep).append_column(name, pa.array(per, mask=np.isnan(per)))
    return score


def _marked(docs: DataFrame, labels: DataFrame, trusted: str, lang: str) -> DataFrame:
    good = labels.groupBy(F.col("doc_id").alias("labelled_id")).agg(
        F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))).alias(trusted)).filter(F.col(trusted))
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    return (docs.withColumn(lang, F.concat(F.lit("l:"), F.coalesce("lang", F.lit("")))).join(good, F.col("doc_id") == F.col("labelled_id"), "left")
            .drop("labelled_id").withColumn(trusted, F.coalesce(trusted, F.lit(False))))


def scored(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, without: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """docs with five columns more, and their names: the language's key, trusted, perplexity, the
    language's threshold, kept. Columns named in `without` are left out."""
    spark = docs.sparkSession
    folder = shared.workspace(spark, "quality")
    lang, trusted, perplexity, threshold, kept, block_ = shared.fresh(
        docs, "language", "trusted", "perplexity", "threshold", "kept", "block")
    added = [lang, trusted, perplexity, threshold, kept]
    labels = labels.select("doc_id", "quality", "toxic")
    marked = _marked(docs, labels, trusted, lang)
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(FOLDS)) == 0
    sizes = marked.groupBy(lang).agg(F.sum(F.length("text")).alias("n"), F.sum(F.when(F.col(trusted) & ~held_out, F.length("text"))).alias("good")).collect()
    if not any(r.good for r in sizes):
        out = marked.drop(*without).withColumns({perplexity: F.lit(None).cast("double"), threshold: F.lit(None).cast("double"), kept: F.lit(True)})
        return out, added
    own = [r[lang] for r in sizes if r.good]
    blocks = max(shared.partitions(spark), -(-sum(r.n or 0 for r in sizes) // BLOCK))
    marked = marked.withColumn(block_, F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    plain = marked.select(F.col(block_).alias("block"), F.col(lang).alias("lang"), (F.col(trusted) & ~held_out).alias("counted"), "text")
    grams = _packed(plain).groupBy("block").applyInArrow(_block_grams, "block long, lang string, code long, n long")
    grams = shared.stored_alone(grams, f"{folder}/grams").withColumnRenamed("lang", "model")
    counts = shared.stored_alone(grams.filter("n > 0").groupBy("model", "code").agg(F.sum("n").alias("n")), f"{folder}/counts")
    logp = probabilities(counts, grams.select("model", "code"), folder)
    shared.dropped(spark, f"{folder}/counts")
    found = grams.select("block", "model", "code").join(logp, ["model", "code"]).select("block", F.col("model").alias("lang"), "code", "logp")

    keep = tuple(c for c in marked.columns if c not in (block_, *without))
    schema = T.StructType([T.StructField(c, marked.schema[c].dataType) for c in keep]).add(perplexity, "double")
    judged = _packed(marked).groupBy(block_).cogroup(found.groupBy("block")).applyInArrow(_score(keep, "text", lang, perplexity), schema)
    judged = shared.stored_alone(judged, f"{folder}/judged")
    aside = judged.filter(F.col(trusted) & held_out & F.col(lang).isin(own))
    limits = aside.groupBy(lang).agg(F.percentile_approx(perplexity, quantile, 100_000).alias(threshold))
    with shared.released(spark):
        limits = spark.createDataFrame(limits.collect(), limits.schema)
    out = judged.join(F.broadcast(limits), lang, "left")
    return out.withColumn(kept, F.coalesce(F.col(perplexity) <= F.col(threshold), F.lit(True))), added


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, perplexity, threshold and kept of every document."""
    out, (_, _, perplexity, threshold, kept) = scored(docs.select("doc_id", "text", "lang"), labels, quantile, without=("text",))
    return out.select("doc_id", "lang", F.round(perplexity, 9).alias("perplexity"), F.round(threshold, 9).alias("threshold"), F.col(kept).alias("kept"))


def without_rejected(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    out, added = scored(docs, labels, quantile)
    return out.filter(F.col(added[-1])).select(*[f"`{c}`" for c in docs.columns])
