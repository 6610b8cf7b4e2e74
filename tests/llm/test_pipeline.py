"""corpus_pipeline: each stage and the whole run against plain Python, on awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from demandloom.llm import mixture, shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid int, Kept string, block int, size string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(f"q{k}", prose(30)) for k in range(6)] + [("short", "Two Words"), ("none", None), ("empty", "")]
    texts = [prose(rng.randint(20, 120)) for _ in range(160)]
    texts += ["".join(rng.choices("XQZ#%&", k=400)) for _ in range(12)]
    texts += [t.replace(" ", "  ", 1).upper() for t in texts[:8]]
    near = texts[20].split()
    near[50 % len(near)] = "another"
    texts += [" ".join(near), texts[21], texts[21], None, "", " \n"]
    texts += [items[0][1] + " " + prose(20), prose(9) + " " + items[1][1].upper() + " " + prose(9), prose(300) + " " + items[2][1][:60]]
    rows = [(k, t, "en" if k % 9 else None, ("hot", "hot", "b", None)[k % 4], 1, 2, "x", 3, "y") for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[30], "en", "b", 1, 2, "x", 3, "y"), (None, None, None, None, None, None, None, None, None)]
    labels = [(k, 1, 0) for k in range(120)] + [(k, 0, 0) for k in range(160, 172)] + [(3, 1, 0), (None, 1, 0), (500, 1, 0)]
    return rows, labels, items


@pytest.fixture(scope="module")
def folder_of(spark, scratch, corpus):
    rows, labels, items = corpus
    where = f"{scratch}/corpus"
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def taken(df):
    return Counter(tuple(r) for r in df.collect())


def without_near(rows):
    """One document of each group: by rows of one set, the smallest doc_id; the rows without one pass."""
    sets = {}
    for r in rows:
        if r[0] is not None:
            w = SPACE.findall(lowered(r[1]))
            sets[r[0]] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in range(4):
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    seen, out = set(), Counter()
    for r in rows:
        if r[0] is None:
            out[r] += 1
        elif root[r[0]] == r[0] and r[0] not in seen:
            seen.add(r[0])
            out[r] += 1
    return out


def without_tests(rows, items):
    windows = {}
    for _, text in items:
        w = ALNUM.findall(lowered(text))
        for k in range(max(1, len(w) - 12)):
            if w:
                windows[tuple(w[k:k + 13])] = len(w[k:k + 13])
    out = Counter()
    for r in rows:
        w, hit = ALNUM.findall(lowered(r[1])), set()
        for window, n in windows.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) == window:
                    hit |= set(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out[r] += 1
    return out


def targets_by_hand(rows):
    size = Counter()
    for r in rows:
        size[r[3]] += len(SPACE.findall(r[1] or ""))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            open_.discard(s)
    return target


def sharded_right(rows, out):
    """Every row once, in the shard of its doc_id, sizes and checksums right, slots without gaps."""
    assert Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars", "rid", "Kept", "block")) for r in out) == \
        Counter(r[:8] for r in rows.elements())
    slots = {}
    for r in out:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], shards.SHARDS)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_stages_against_plain_python(spark, folder_of, corpus):
    rows, labels, items = corpus
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    assert names == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding"]

    kept = taken(stage[names[0]](spark, docs, folder_of))
    assert not kept - Counter(rows)
    junk = {k for k in range(160, 172)}
    assert not junk & {r[0] for r in kept} and sum(kept[r] for r in rows[:120]) >= 0.97 * 120
    assert all(kept[r] for r in rows if not r[1])

    assert taken(stage[names[1]](spark, docs, folder_of)) == without_near(rows)
    assert taken(stage[names[2]](spark, docs, folder_of)) == without_tests(rows, items)

    mixed = stage[names[3]](spark, docs, folder_of)
    assert mixed.columns == docs.columns
    got, whole = taken(mixed), Counter(rows)
    assert set(got) <= set(whole) and all(n <= 2 * whole[r] for r, n in got.items())
    words = lambda r: len(SPACE.findall(r[1] or ""))
    longest = max(map(words, rows))
    for source, target in targets_by_hand(rows).items():
        assert abs(sum(n * words(r) for r, n in got.items() if r[3] == source) - target) <= longest
    assert taken(stage[names[3]](spark, docs.repartition(5), folder_of)) == got

    sharded_right(Counter(rows), stage[names[4]](spark, docs, folder_of).collect())
    one, two = (sorted((r["shard"], r["slot"], r["doc_id"] or -1, r["n_chars"] or -1) for r in stage[names[4]](spark, d, folder_of).collect())
                for d in (docs, docs.repartition(7)))
    assert one == two


def test_run_is_its_stages_one_after_another(spark, folder_of, corpus):
    rows, _, items = corpus
    out = corpus_pipeline.run(spark, folder_of).collect()
    kept = taken(corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{folder_of}/documents.parquet"), folder_of))
    left = without_tests(list(without_near(list(kept.elements())).elements()), items)
    assert {(r["doc_id"], r["text"]) for r in out} <= {r[:2] for r in left}
    total = Counter((r["doc_id"], r["text"]) for r in out)
    words = lambda text: len(SPACE.findall(text or ""))
    target = targets_by_hand(list(left.elements()))
    assert abs(sum(n * words(t) for (_, t), n in total.items()) - sum(target.values())) <= len(target) * max(words(r[1]) for r in left)
    assert {r["shard"] for r in out} <= set(range(shards.SHARDS))


def test_empty_tables(spark, scratch):
    where = f"{scratch}/nothing"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{where}/benchmark.parquet")
    assert corpus_pipeline.run(spark, where).count() == 0


def test_rows_that_share_a_hash_are_not_lost(spark, monkeypatch):
    rows = [(k % 7, f"word {k % 3}", "en", "s", 1) for k in range(3000)] + [(k, "x y", "en", "t", 1) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = taken(mixture.mixed(docs))
    whole = Counter(rows)
    assert all(n <= 2 * whole[r] for r, n in out.items())
    by_source = Counter()
    for r, n in out.items():
        by_source[r[3]] += 2 * n
    target = targets_by_hand(rows)
    assert all(abs(by_source[s] - t) <= 2 for s, t in target.items())
