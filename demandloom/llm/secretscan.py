"""Secret scans: fixed patterns, and a character network over every other candidate.

Patterns, leftmost and non-overlapping for each kind: `assign` a credential's name with a value of
six characters or more, `access` an access key, `hex` a long hexadecimal run. A candidate is a run
of CANDIDATE characters or more of `[A-Za-z0-9+/_.=-]` with a digit, and the window around it. The
labelled findings are the candidates themselves: those that touch a pattern's match are secrets,
others are not. The network learns from every distinct window: in each of EPOCHS passes, blocks of
about BLOCK windows each go on from the same weights by Adam, and the mean of their weights is what
the next pass begins with. A quarter of the windows, by a seeded hash, is held out, all of it for
calibration and for the threshold, the highest that finds RECALL of the held-out secrets. Only weights
and sums come to the driver. Candidates the network finds that no pattern did are added as `learned`
spans. With fewer than LEAST windows of either label nothing is learned.

Every text is scanned whole, once; what the network needs is written to the shared folder. Null and
empty texts have no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import charcnn, shared, wordcodes

# Fixed values of the contract.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
VALUE_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

NAMES = (b"password", b"passwd", b"secret", b"token", b"api")
CANDIDATE = 16
BLOCK, LEAST, RECALL, EPOCHS, SEED = 6144, 40, 0.98, 8, 17
#: one in FOLDS windows is held out
FOLDS = 4
#: weights are added up as whole numbers of this size, so that the order of the blocks does not count
_GRAIN = 2.0 ** -40
_TOKEN = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", np.uint8))
_DIGIT = np.isin(np.arange(256), np.arange(0x30, 0x3A))
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_WINDOW = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("window", pa.string()), ("found", pa.bool_())])
SCANNED = ("doc_id long, base array<struct<kind:string,start:int,end:int>>, "
           "candidates array<struct<start:int,end:int,window:string,found:boolean>>")


def pattern_spans(text: bytes, long_token: bool = True) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(name in low for name in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_LEAST]
    if long_token:
        if b"AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(out)]


def _window(text: str, start: int, end: int) -> str:
    """The code points around a candidate, padded with U+0000 to a fixed length."""
    left = text[max(0, start - charcnn.LEFT):start].rjust(charcnn.LEFT, "\0")
    body = text[start:min(end, start + charcnn.BODY)].ljust(charcnn.BODY, "\0")
    return left + body + text[end:end + charcnn.RIGHT].ljust(charcnn.RIGHT, "\0")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in wordcodes.chunks(batches, "text"):
        runs = wordcodes.Words(data, at, _TOKEN)
        size = runs.ends - runs.starts
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        big = np.flatnonzero(size >= CANDIDATE)
        row_of = np.searchsorted(runs.of, big, "right") - 1
        digit = digits[runs.ends[big]] > digits[runs.starts[big]]
        first = np.searchsorted(row_of, np.arange(batch.num_rows + 1))
        raw = data.tobytes()
        base, candidates = [], []
        for row in range(batch.num_rows):
            here = slice(first[row], first[row + 1])
            text = raw[at[row]:at[row + 1]]
            spans = pattern_spans(text, bool((size[big[here]] >= ACCESS_LEAST).any()))
            places = [(int(runs.starts[k] - at[row]), int(runs.ends[k] - at[row])) for k in big[here][digit[here]]]
            if not spans and not places:
                base.append([])
                candidates.append([])
                continue
            # byte positions to code points
            follow = np.concatenate([[0], np.cumsum((data[at[row]:at[row + 1]] & 0xC0) == 0x80)])
            point = lambda k: int(k - follow[k])
            whole = text.decode("utf-8", "replace")
            base.append([{"kind": kind, "start": point(s), "end": point(e)} for kind, s, e in spans])
            candidates.append([{"start": point(s), "end": point(e), "window": _window(whole, point(s), point(e)),
                                "found": any(s < e2 and s2 < e for _, s2, e2 in spans)} for s, e in places])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_WINDOW))], ["doc_id", "base", "candidates"])


def _trained(model: charcnn.CharCNN, weights: np.ndarray, each: tuple[float, float], seed: int):
    """One pass over a block's windows from the given weights, to (place, value, n) of its own weights; `each` is a window's weight by label."""
    def trained(block: pa.Table) -> pa.Table:
        block = block.sort_by("window")
        y = np.array(block.column("found").to_pylist(), float)
        model.put(weights.copy())
        model.fit(charcnn.encoded(block.column("window").to_pylist()), y, 1, seed, weight=np.where(y == 1, each[1], each[0]))
        own = np.rint(model.weights() / _GRAIN).astype(np.int64)
        return pa.table({"place": pa.array(np.arange(len(own), dtype=np.int32)), "value": own, "n": np.full(len(own), len(y), np.int64)})
    return trained


def _scored(model: charcnn.CharCNN):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.score(charcnn.encoded(batch.column("window").to_pylist())) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(z), batch.column("found")], ["z", "found"])
    return score


def _at_rank(scores: DataFrame, rank: int, bins: int = 1024) -> float:
    """The value of scores(z) that has exactly `rank` values before it in order, by counts in ever smaller bins."""
    low, high = scores.agg(F.min("z"), F.max("z")).first()
    while low < high:
        place = F.least(F.floor((F.col("z") - low) / ((high - low) / bins)), F.lit(bins - 1))
        for found in scores.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high")).orderBy("place").collect():
            if rank < found.n:
                break
            rank -= found.n
        low, high = found.low, found.high
        scores = scores.filter(F.col("z").between(low, high))
    return low


def train(findings: DataFrame, recall: float = RECALL) -> charcnn.CharCNN | None:
    """A network from all of findings(window, found), trained and calibrated where they lie."""
    folder = shared.workspace(findings.sparkSession, "findings")
    distinct = findings.groupBy("window").agg(F.max("found").alias("found"))
    distinct = shared.stored(distinct.withColumn("held", F.pmod(F.xxhash64("window", F.lit(SEED)), F.lit(FOLDS)) == 0), f"{folder}/windows")
    n = {(r.found, r.held): r.n for r in distinct.groupBy("found", "held").agg(F.count("*").alias("n")).collect()}
    if min(n.get((found, True), 0) + n.get((found, False), 0) for found in (False, True)) < LEAST:
        return None
    seen = {found: n.get((found, False), 0) for found in (False, True)}
    blocks = -(-sum(seen.values()) // BLOCK)
    each = tuple(sum(seen.values()) / 2 / max(1, seen[found]) for found in (False, True))
    learned = distinct.filter(~F.col("held")).select("window", "found", F.pmod(F.xxhash64("window", F.lit(SEED + 1)), F.lit(blocks)).alias("block"))
    model = charcnn.CharCNN(SEED)
    for turn in range(EPOCHS):
        passed = learned.groupBy("block").applyInArrow(_trained(model, model.weights(), each, SEED + turn), "place int, value long, n long")
        means = passed.groupBy("place").agg((F.sum(F.col("value").cast("decimal(20,0)") * F.col("n").cast("decimal(12,0)")).cast("double") / F.sum("n")).alias("mean"))
        rows = means.collect()
        weights = np.empty(len(rows))
        weights[[r.place for r in rows]] = [r["mean"] * _GRAIN for r in rows]
        model.put(weights)

    scores = shared.stored(distinct.filter("held").select("window", "found").mapInArrow(_scored(model), "z double, found boolean"), f"{folder}/scores")
    secrets, others = n.get((True, True), 0), n.get((False, True), 0)
    weight = F.when(F.col("found"), 0.5 / max(1, secrets)).otherwise(0.5 / max(1, others))

    def sums(a: float, b: float) -> tuple[float, ...]:
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.col("z") * a + b))))
        g, h = weight * (p - F.col("found").cast("double")), weight * p * (1 - p)
        z = F.col("z")
        return tuple(x or 0.0 for x in scores.agg(F.sum(g * z), F.sum(g), F.sum(h * z * z), F.sum(h * z), F.sum(h)).first())

    model.scale, model.shift = charcnn.platt(sums)
    least = _at_rank(scores.filter("found"), int(np.floor((1 - recall) * secrets))) if secrets else None
    model.threshold = 1.1 if least is None else float(model.likely(np.array([least]))[0])
    return model


def _joined(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def _judge(model: charcnn.CharCNN | None):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, candidates = batch.column("base").to_pylist(), batch.column("candidates").to_pylist()
            open_ = [(row, c) for row, own in enumerate(candidates) for c in own if not c["found"]]
            learned: list[list] = [[] for _ in base]
            if model and open_:
                for at in range(0, len(open_), 8192):
                    part = open_[at:at + 8192]
                    likely = model.probability(charcnn.encoded([c["window"] for _, c in part]))
                    for (row, c), p in zip(part, likely.tolist()):
                        if p >= model.threshold:
                            learned[row].append((c["start"], len(KINDS), "learned", c["end"]))
            counts = [[sum(s["kind"] == kind for s in own) for own in base] for kind in KINDS]
            plain = [[(s["start"], KINDS.index(s["kind"]), s["kind"], s["end"]) for s in own] for own in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in plain], pa.string()),
                 pa.array([_joined(s + more) for s, more in zip(plain, learned)], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return judge


def scan(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of docs(doc_id, text, ...)."""
    folder = shared.workspace(docs.sparkSession, "secrets")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = shared.stored(base.mapInArrow(_scan, SCANNED), f"{folder}/scanned")
    model = train(scanned.select(F.explode("candidates").alias("c")).select("c.window", "c.found"), recall)
    return scanned.mapInArrow(_judge(model), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
