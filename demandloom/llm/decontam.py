"""Benchmark decontamination: an FM-index for each shard of training text, searched for test phrases.

A phrase is `width` consecutive words of a benchmark item, or the whole item where it has fewer
(but any). Words are runs of digits, letters a-z after A-Z became a-z, and non-ASCII characters.
Documents are indexed in shards of about SHARD_BYTES, in the task that reads them:
suffix array, wavelet-tree ranks of the transformed text, and every SAMPLE-th suffix position. All
phrases are searched backwards at once; occurrences are located and merged to spans of words.

The index's alphabet is the benchmark's words. A run of them shorter than the shortest phrase
cannot hold one and is left out; the rest of a shard is indexed whole, runs parted by symbol 0.

Benchmark items travel to the tasks in blocks of at most BLOCK_BYTES of text; each block is one
more pass over the documents' rows, not over the input, so a large benchmark needs no more memory.

Null and empty texts have no words and no hits; items without words give no phrase. Items with the
same item_id count once, null item_ids not at all in n_items, though their phrases are hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes
from demandloom.llm.fmindex import FMIndex

WIDTH = 13
#: text of one FM-index
SHARD_BYTES = 2 << 20
#: benchmark text that is sent to the tasks at once
BLOCK_BYTES = 16 << 20


class Phrases:
    """Distinct phrases of some items as rows of word numbers, and which items each stands in."""

    def __init__(self, items: pa.Table, width: int) -> None:
        data, at = wordcodes.flat(items.column("text"))
        words = wordcodes.Words(data, at, wordcodes.ALNUM)
        codes = words.codes(fold=True)
        self.vocabulary = np.unique(codes)
        numbers = np.searchsorted(self.vocabulary, codes) + 1
        rows, lengths, owners = [], [], []
        for item, first, end in zip(items.column("item_id").to_pylist(), words.of[:-1].tolist(), words.of[1:].tolist()):
            n = min(width, end - first)
            for start in range(first, end - n + 1) if n else ():
                rows.append(np.pad(numbers[start:start + n], (0, width - n)))
                lengths.append(n)
                owners.append(item)
        table = np.array(rows, np.int32).reshape(-1, width)
        self.rows, which = np.unique(table, axis=0, return_inverse=True)
        self.lengths = (self.rows > 0).sum(axis=1)
        self.owners: list[set] = [set() for _ in self.rows]
        for phrase, item in zip(which.ravel().tolist(), owners):
            if item is not None:
                self.owners[phrase].add(str(item))

    @property
    def shortest(self) -> int:
        return int(self.lengths.min(initial=1 << 30))


def _find(phrases: Phrases, words: wordcodes.Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, phrase) of every occurrence in a shard."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(phrases.rows) or not len(words):
        return none
    codes = words.codes(fold=True)
    place = np.minimum(np.searchsorted(phrases.vocabulary, codes), len(phrases.vocabulary) - 1)
    number = np.where(phrases.vocabulary[place] == codes, place + 1, 0)
    # runs of benchmark words within a document that are long enough for some phrase
    brk = number == 0
    new_row = np.zeros(len(number), bool)
    new_row[words.of[:-1][words.of[:-1] < len(number)]] = True
    run = np.cumsum(brk | new_row)
    size = np.bincount(run[~brk], minlength=int(run[-1]) + 1)
    keep = ~brk & (size[run] >= phrases.shortest)
    where = np.flatnonzero(keep)
    if not len(where):
        return none
    part = np.ones(len(where), bool)
    part[1:] = run[where[1:]] != run[where[:-1]]
    slot = np.arange(len(where)) + np.cumsum(part) - 1
    # symbol 1 parts the runs, 0 ends the text; words follow
    text = np.ones(int(slot[-1]) + 2, np.int64)
    text[slot] = number[where] + 1
    text[-1] = 0
    source = np.full(len(text), -1, np.int64)
    source[slot] = where
    index = FMIndex(text, len(phrases.vocabulary) + 2)
    low, high = index.search(phrases.rows + 1, phrases.lengths)
    count = high - low
    phrase = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
    return source[index.locate(low[phrase] + within)], phrase


def _hits(block, keep: tuple[str, ...], added: tuple[str, str, str]):
    """Adds the block's hits to what earlier blocks found: word spans and item ids of each row."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for batch, data, at in wordcodes.chunks(batches, "text", SHARD_BYTES):
            words = wordcodes.Words(data, at, wordcodes.ALNUM)
            first, phrase = _find(phrases, words)
            order = np.argsort(first, kind="stable")
            first, phrase = first[order], phrase[order]
            bound = np.searchsorted(first, words.of)
            spans, items = batch.column(added[1]).to_pylist(), batch.column(added[2]).to_pylist()
            for row in np.flatnonzero(np.diff(bound)).tolist():
                here = slice(bound[row], bound[row + 1])
                start = first[here] - words.of[row]
                end = start + phrases.lengths[phrase[here]]
                spans[row] = _merged(spans[row] + np.stack([start, end], 1).ravel().tolist())
                items[row] = sorted(set(items[row]).union(*(phrases.owners[p] for p in set(phrase[here].tolist()))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(words.per_row(), pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(items, pa.list_(pa.string()))], [*keep, *added])
    return hits


def _merged(flat: list[int]) -> list[int]:
    """Spans as first, end, first, end, ...: sorted, those that touch or overlap joined."""
    out: list[int] = []
    for start, end in sorted(zip(flat[::2], flat[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """The benchmark's items, at most block_bytes of text (or one item) at a time."""
    n = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-n // block_bytes) or 1
    for part in range(parts):
        yield (benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
               .filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).toArrow())


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                       block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """docs with three columns more, and their names: the number of words, the spans that are hit
    (word positions first, end, first, end, ...) and the ids of the items that occur."""
    spark = docs.sparkSession
    added = shared.fresh(docs, "n_words", "spans", "items")
    keep = tuple(docs.columns)
    out = docs.withColumns({added[1]: F.array().cast("array<int>"), added[2]: F.array().cast("array<string>")})
    kinds = [(f.name, f.dataType.simpleString()) for f in docs.schema]
    kinds += list(zip(added, ("bigint", "array<int>", "array<string>")))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds)
    for table in benchmark_blocks(benchmark, block_bytes):
        block = spark.sparkContext.broadcast(Phrases(table, width))
        out = out.select(*[f"`{c}`" for c in keep], *added[1:]).mapInArrow(_hits(block, keep, tuple(added)), schema)
    return out, added


def n_hit(spans: str):
    """Words inside the spans of a column."""
    return F.aggregate(F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long")),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(hit, n_words):
    """The rule: some word is hit, and at least one in twenty."""
    return (hit > 0) & (20 * hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans and items of every document."""
    found, _ = find_contamination(docs.select("doc_id", "text"), benchmark, width)
    return (found.withColumn("n_hit", n_hit("spans"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), "spans", "items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that the rule leaves, with their own columns."""
    found, (n_words, spans, _) = find_contamination(docs, benchmark, width)
    return found.filter(~contaminated(n_hit(spans), F.col(n_words))).select(*[f"`{c}`" for c in docs.columns])
