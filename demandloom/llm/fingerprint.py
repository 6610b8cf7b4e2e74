"""Quartile bucket digests of texts, and the likeness of two digests.

Every three bytes out of four neighbours that include the first are hashed to one of BUCKETS
buckets and counted. The digest holds the text's length class, how far apart the quartiles of the
counts are, and for each bucket the quarter that its count lies in (two bits). The difference of
two digests adds up the buckets' distances (0 to 3, the far corner weighing 6 as it is rarest), the
length classes' and the quartile ratios'. It is bounded: likeness is 1 less the difference over what
unrelated digests are expected to reach, and not below 0. Equal texts have equal digests.

A text of under 3 bytes has no triplets; null counts as empty. The next document is the next row by
doc_id (null first), then text; the last one's is the first. A single row is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes

BUCKETS = 256
#: the triplets of a window of four bytes: places of the second and third byte
TRIPLETS = ((1, 2), (1, 3), (2, 3))
#: growth of text length from one length class to the next
LENGTH_STEP = 1.25
_GAP = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]], np.int64)
#: the expected bucket difference of unrelated digests; at this and beyond the likeness is 0
FAR = BUCKETS * _GAP.mean()


def bucket_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """rows x BUCKETS counts of the triplets inside each row."""
    rows = len(at) - 1
    out = np.zeros(rows * BUCKETS, np.int64)
    row = np.repeat(np.arange(rows), np.diff(at))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(data))
    for k, (second, third) in enumerate(TRIPLETS):
        n = max(0, len(data) - third)
        code = data[:n].astype(np.uint32) | data[second:second + n].astype(np.uint32) << 8 | data[third:third + n].astype(np.uint32) << 16
        code = (code + np.uint32(k << 24)) * np.uint32(0x9E3779B1)
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77)
        inside = left[:n] > third
        slot = row[:n][inside] * BUCKETS + (code[inside] >> np.uint32(24)).astype(np.int64)
        out += np.bincount(slot, minlength=rows * BUCKETS)
    return out.reshape(rows, BUCKETS)


class Digests:
    """The digests of some rows: lengths and ratios (classes 0 to 255), quarters (rows x BUCKETS)."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray) -> None:
        ordered = np.sort(counts, axis=1)
        q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
        self.quarters = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8)
        self.length = np.where(sizes > 0, np.minimum(255, 1 + np.floor(np.log(np.maximum(sizes, 1)) / np.log(LENGTH_STEP))), 0).astype(np.int64)
        top = np.maximum(q3, 1)
        self.ratios = np.concatenate([q1 * 15 // top, q2 * 15 // top], axis=1).astype(np.int64)

    def text(self) -> list[str]:
        q = self.quarters
        body = q[:, 0::4] << 6 | q[:, 1::4] << 4 | q[:, 2::4] << 2 | q[:, 3::4]
        head = np.stack([self.length, self.ratios[:, 0] << 4 | self.ratios[:, 1]], axis=1).astype(np.uint8)
        whole = np.concatenate([head, body], axis=1)
        return [row.tobytes().hex() for row in whole]


def likeness(a: Digests, b: Digests) -> np.ndarray:
    gap = _GAP[a.quarters, b.quarters].sum(axis=1)
    gap = gap + np.abs(a.length - b.length) + np.abs(a.ratios - b.ratios).sum(axis=1)
    return np.maximum(0.0, 1.0 - gap / FAR)


def digests(texts: list[bytes]) -> Digests:
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    return Digests(bucket_counts(np.frombuffer(b"".join(texts), np.uint8), at), sizes)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edited string, part long, guest boolean")


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, guest last, doc_id and text; a guest closes its part and gives no row.

    What is held at once is bounded in characters and, by BUCKETS for each, in rows.
    """
    held: list[tuple] = []
    size = 0

    def flush(rows):
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        edited, n_chars = [], []
        for text, after in zip(texts[:-1], texts[1:]):
            cut = len(text) // 4
            edited.append(text[:len(text) - cut] + after[:cut])
            n_chars.append(len(text))
        raw = [t.encode() for t in edited]
        own, new = digests([t.encode() for t in texts]), digests(raw)
        first, rest = _rows(own, slice(0, -1)), _rows(own, slice(1, None))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[:-1], pa.int64()), pa.array(n_chars, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
             pa.array(first.text(), pa.string()), pa.array(new.text(), pa.string()),
             pa.array(likeness(first, new)), pa.array(likeness(first, rest)), pa.array(edited, pa.string())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "guest")]
        for doc_id, text, guest in zip(*columns):
            held.append((doc_id, text or ""))
            size += len(held[-1][1]) + BUCKETS
            if guest or size > wordcodes.CHUNK:
                if len(held) > 1:
                    yield flush(held)
                held = [] if guest else held[-1:]
                size = 0


def _rows(d: Digests, which: slice) -> Digests:
    out = object.__new__(Digests)
    out.quarters, out.length, out.ratios = d.quarters[which], d.length[which], d.ratios[which]
    return out


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited.

    The documents are dealt to ranges of doc_id, whose bounds are quantiles of all ids; the first
    document of each range is also sent to the range before it, as its last row's next.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts or 4 * shared.partitions(spark)
    at = [k / parts for k in range(1, parts)]
    bounds = base.agg(F.percentile_approx("doc_id", at, 20 * parts) if at else F.lit(None)).first()[0]
    bounds = sorted(set(bounds or []))
    part = F.coalesce(F.size(F.filter(F.lit(bounds).cast("array<long>"), lambda b: b < F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    own = base.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("long"))
    # one row a range: its first document, and the range before it that has any
    order = F.struct(F.col("doc_id").isNotNull().alias("x"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    firsts = own.select("part", "doc_id").groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("x"), "doc_id")).alias("f"))
    begins = [(r.part, r.f.doc_id) for r in firsts.orderBy("part").collect()]
    if not begins:
        return spark.createDataFrame([], SCHEMA).drop("part", "guest")
    before = {begin[0]: begins[i - 1][0] for i, begin in enumerate(begins)}
    lead = spark.createDataFrame([(p, d, before[p]) for p, d in begins], "part long, first long, goes long")
    heads = (own.join(F.broadcast(lead), "part").filter(F.col("doc_id").eqNullSafe(F.col("first")))
             .groupBy("goes").agg(F.min(order).alias("o")).select(F.col("goes").alias("part"), "o.doc_id", "o.text", F.lit(True).alias("guest")))
    rows = own.select("part", "doc_id", "text", F.lit(False).alias("guest")).unionByName(heads)
    n = shared.partitions(spark)
    rows = rows.repartition(n, "part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    return rows.mapInArrow(_with_next, SCHEMA.rsplit(", part", 1)[0])
