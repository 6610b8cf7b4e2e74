"""Repeated passages: windows of `length` words that start anywhere else are removed, word by word.

Level-wise doubling. The first level is windows of 9 words (for a length of 35), thinned to those
with the smallest code among the windows of some passage of full length: two equal passages have
the same one. Those that repeat are extended to twice the length, 18 words, to the left and to the
right of the anchor; the passages of 35 words that hold a repeated 18 on the side with room are
counted last. Nothing that is repeated at full length is lost on the way, since each of its parts
repeats as well. Codes are 64 bits, and the last level's key holds the anchor's code beside the
passage's own.

A code that recurs within a task is settled there, and only one row for it is sent on, so that a
passage in a third of all documents does not gather in one task. Rows that are settled travel by
document instead of by code.

Words are runs of `[^\\x20\\x09-\\x0D]`. Null and empty texts have no words; texts under `length`
words keep them all. Rows alike in doc_id and text count as two texts and lose the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes

LENGTH = 35
#: candidate passages of a task that are settled together: 2 MB for each of four columns
GATHER = 250_000
_BASE = 0xC2B2AE3D27D4EB4F
ALONE, SETTLED, WITNESS = 0, 1, 2


def steps(length: int) -> tuple[int, int]:
    """The two shorter levels: the first such that twice it, twice again, reaches `length`."""
    first = max(1, -(-length // 4))
    return first, min(length, 2 * first)


def _runs(codes: np.ndarray, width: int) -> np.ndarray:
    """A code for each run of `width` words, wherever rows end."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    return wordcodes.mixed(wordcodes.rolled(codes, at, at + width, _BASE) + np.uint64(width))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for every i, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


class Passages:
    """Anchors of the passages of one chunk of texts."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int) -> None:
        self.words = wordcodes.Words(data, at, wordcodes.VISIBLE)
        self.length, (self.short, self.middle) = length, steps(length)
        self.codes = self.words.codes()
        self.grams = _runs(self.codes, self.short)
        n = max(0, len(self.codes) - length + 1)
        self.least = _sliding_min(self.grams, length - self.short + 1)[:n] if n else np.empty(0, np.uint64)
        inside = np.zeros(n, bool)
        per_row = self.words.per_row()
        long_rows = np.flatnonzero(per_row >= length)
        for row in long_rows.tolist():
            inside[self.words.of[row]:self.words.of[row + 1] - length + 1] = True
        #: first words of the passages that lie in one row, and that row
        self.starts = np.flatnonzero(inside)
        self.row = np.searchsorted(self.words.of, self.starts, "right") - 1
        self.least = self.least[self.starts]
        self.offset = self._offsets()

    def _offsets(self) -> np.ndarray:
        """Where in its passage the (first) smallest short window begins."""
        span = self.length - self.short + 1
        out = np.full(len(self.starts), -1, np.int64)
        for i in range(span - 1, -1, -1):
            hit = self.grams[self.starts + i] == self.least
            out[hit] = i
        return out

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Words at which an anchor begins, and their rows."""
        at, first = np.unique(self.starts + self.offset, return_index=True)
        return at, self.row[first]

    def middles(self, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the doubled windows that end with, and begin with, the anchors (0: no room)."""
        wide = _runs(self.codes, self.middle)
        left_at, right_ok = at - (self.middle - self.short), at + self.middle <= self.words.of[row + 1]
        left_ok = left_at >= self.words.of[row]
        left, right = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        left[left_ok] = wide[left_at[left_ok]]
        right[right_ok] = wide[at[right_ok]]
        return left, right

    def side_codes(self) -> np.ndarray:
        """For each passage the code of the doubled window around its anchor that lies inside it."""
        wide = _runs(self.codes, self.middle)
        at = self.starts + self.offset
        right = self.offset + self.middle <= self.length
        return wide[np.where(right, at, at - (self.middle - self.short))]

    def full_codes(self) -> np.ndarray:
        return _runs(self.codes, self.length)[self.starts]


def _anchor_rows(length: int):
    def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in wordcodes.chunks(batches, "text"):
            p = Passages(data, at, length)
            where, row = p.anchors()
            left, right = p.middles(where, row)
            value = p.grams[where]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(left.view(np.int64)), pa.array(right.view(np.int64)),
                 batch.column("rid").take(pa.array(row)), pa.array(_settle(value))], ["value", "low", "high", "rid", "state"])
    return anchor_rows


def _settle(*keys: np.ndarray) -> np.ndarray:
    """ALONE where a key occurs once here; else SETTLED, and WITNESS for the first of its rows."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(order)))
    state = np.full(len(order), SETTLED, np.int8)
    state[begin] = np.where(count > 1, WITNESS, ALONE)
    out = np.empty(len(order), np.int8)
    out[order] = state
    return out


def _settle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        value = batch.column("value").to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column("value"), batch.column("rid"), pa.array(_settle(value))], ["value", "rid", "state"])


def _repeated_only(keys: tuple[str, ...]):
    """Rows, sorted by settled-or-not and key, whose key is known to recur; others are dropped.

    Of a key that goes on in the next batch only its first row is held back, and whether it was seen.
    """
    def repeated_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known, last = None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            state = batch.column("state").to_numpy()
            columns = [batch.column(k).to_numpy() for k in keys]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            ident = [c[0] for c in columns]
            same = last is not None and ident == last
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, batch.num_rows))
            sure = (count > 1) | np.logical_or.reduceat(state != ALONE, begin)
            if same:
                sure[0] |= known or held is not None
            if held is not None and same:
                yield held
            keep = np.repeat(sure, count) | (state == SETTLED)
            last, known = [c[-1] for c in columns], bool(sure[-1])
            held = None if known else batch.slice(batch.num_rows - 1, 1)
            yield batch.filter(pa.array(keep))
    return repeated_only


def _recurring(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows whose key occurs in another row as well."""
    route = F.when(F.col("state") == SETTLED, F.xxhash64("rid")).otherwise(F.xxhash64(*keys))
    n = shared.partitions(rows.sparkSession)
    sent = rows.repartition(n, route).sortWithinPartitions(F.col("state") == SETTLED, *keys)
    return sent.mapInArrow(_repeated_only(keys), rows.schema)


def _passage_rows(length: int):
    """Passages whose doubled window repeats; neighbours that are settled here share a row."""
    def flush(parts):
        value, anchor, rid, at = (np.concatenate(x) for x in zip(*parts))
        state = _settle(value, anchor)
        new = np.ones(len(value), bool)
        new[1:] = (state[1:] != SETTLED) | (state[:-1] != SETTLED) | (rid[1:] != rid[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(value)))
        return pa.RecordBatch.from_arrays(
            [pa.array(value[begin].view(np.int64)), pa.array(anchor[begin].view(np.int64)), pa.array(rid[begin]),
             pa.array(at[begin].astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(state[begin])],
            ["value", "anchor", "rid", "at", "n", "state"])

    def passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch, data, at in wordcodes.chunks(batches, "text"):
            p = Passages(data, at, length)
            if not len(p.starts):
                continue
            wanted = batch.column("wanted")
            ends, values = wanted.offsets.to_numpy(), wanted.values.to_numpy()
            side = p.side_codes().view(np.int64)
            hit = np.zeros(len(side), bool)
            first = np.searchsorted(p.row, np.arange(batch.num_rows + 1))
            for row in range(batch.num_rows):
                here = slice(first[row], first[row + 1])
                hit[here] = np.isin(side[here], values[ends[row]:ends[row + 1]])
            at_words = p.starts - p.words.of[p.row]
            rid = batch.column("rid").to_numpy()[p.row]
            parts.append((p.full_codes()[hit], p.least[hit], rid[hit], at_words[hit]))
            size += int(hit.sum())
            if size >= GATHER:
                yield flush(parts)
                parts, size = [], 0
        if size:
            yield flush(parts)
    return passage_rows


def _without(length: int):
    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in wordcodes.chunks(batches, "text"):
            total, gone, digests, texts = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                removed = np.zeros(len(words) + 1, np.int32)
                for span in spans or ():
                    removed[span["at"]] += 1
                    removed[min(len(words), span["at"] + span["n"] + length - 1)] -= 1
                covered = np.cumsum(removed[:-1]) > 0
                kept = b" ".join(w for w, c in zip(words, covered.tolist()) if not c) if spans else b" ".join(words)
                total.append(len(words))
                gone.append(int(covered.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])
    return without


def remove_repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and kept_sha256 of every row of docs(doc_id, text, ...)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.xxhash64("doc_id", "text"))
    anchors = base.mapInArrow(_anchor_rows(length), "value long, low long, high long, rid long, state byte")
    doubled = (_recurring(anchors, "value")
               .select("rid", F.explode(F.array("low", "high")).alias("value")).filter("value <> 0")
               .select("value", "rid").mapInArrow(_settle_rows, "value long, rid long, state byte"))
    wanted = _recurring(doubled, "value").groupBy("rid").agg(F.collect_set("value").alias("wanted"))
    # both joins with the texts name the same columns, so that the texts are shuffled once
    passages = (base.select("rid", "doc_id", "text").join(wanted, "rid").select("rid", "doc_id", "text", "wanted")
                .mapInArrow(_passage_rows(length), "value long, anchor long, rid long, at int, n int, state byte"))
    spans = _recurring(passages, "value", "anchor").groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    return (base.select("rid", "doc_id", "text").join(spans, "rid", "left").select("rid", "doc_id", "text", "spans")
            .mapInArrow(_without(length), "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"))
