"""The training-data operators on awkward rows, held against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import charcnn, decontam, fingerprint, mixture, neardup, quality, secretscan, shards, substrings, urlfilter, warc
from demandloom.llm.fmindex import FMIndex
from demandloom.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, size long, shard int, spans string"
SPACE = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(SPACE, text or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 6))) for _ in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=n)) for n in (120, 90, 60, 45, 30, 200)]
    out = {0: None, 1: "", 2: " \t\n", 3: "one", 4: "One two three", 5: "one two three", 6: "A B C D", 7: base[0], 8: base[0]}
    for k, text in enumerate(base):
        near = text.split()
        near[3] = "changed"
        out[10 + k] = " ".join(near)
        out[20 + k] = text + " " + base[(k + 1) % len(base)]
        out[30 + k] = text.upper() + "\x0b tail"
    out[40] = " ".join(rng.choices(vocabulary, k=6000))
    out[41] = "x" * 100_000
    out[42] = out[40].replace("a", "b", 1)
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "é")[i % 4], 1, 2, "x") for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicates(docs, empty, texts):
    sets = {}
    for i, t in texts.items():
        w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                k = len(sets[a] & sets[b])
                if k and 100 * k >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    found = by_id(neardup.near_duplicates(docs))
    assert {i: (len(sets[i]), root[i], root[i] == i) for i in sets} == {i: tuple(r)[1:] for i, r in found.items()}
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_repeated_and_null_ids(spark):
    text = "a b c d e f g"
    rows = [(1, text), (1, "h i j k l"), (2, text), (3, "h i j k l"), (None, text)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]


def test_components(spark, folder):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    root = {n: n for pair in links for n in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), folder).collect()}
    assert found == {n: r for n, r in root.items() if any(n in p and p[0] != p[1] for p in links)}


def test_repeated_passages(docs, empty, texts):
    w = {i: words_of(t) for i, t in texts.items()}
    seen = Counter(tuple(x[k:k + 35]) for x in w.values() for k in range(len(x) - 34))
    found = by_id(substrings.remove_repeated(docs))
    for i, x in w.items():
        gone = [False] * len(x)
        for k in range(len(x) - 34):
            if seen[tuple(x[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        kept = " ".join(a for a, g in zip(x, gone) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_text) == (len(x), sum(gone), kept), i
        assert found[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert substrings.remove_repeated(empty).count() == 0


def test_repeated_within_one_text_and_equal_rows(spark):
    unit = " ".join(f"w{k}" for k in range(40))
    rows = [(1, unit + " x " + unit), (2, "only once " + " ".join(f"v{k}" for k in range(50))), (3, unit[3:]), (3, unit[3:])]
    found = [(r.doc_id, r.n_removed) for r in substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(found) == [(1, 80), (2, 0), (3, 39), (3, 39)]


def test_fm_index():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 700), 0)
    index = FMIndex(text, 5)
    phrases = np.zeros((40, 4), np.int64)
    lengths = rng.integers(1, 5, 40)
    for k, n in enumerate(lengths):
        phrases[k, :n] = rng.integers(1, 5, n)
    low, high = index.search(phrases, lengths)
    for k, n in enumerate(lengths):
        expected = [i for i in range(700 - n + 1) if (text[i:i + n] == phrases[k, :n]).all()]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == expected


def test_decontamination(spark, docs, empty, texts):
    pattern = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = lambda t: re.findall(pattern, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    items = [(7, " ".join(texts[20].split()[5:30])), (12, "one two"), (3, None), (4, "..."), (12, "A, b C"), (None, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    phrases = {}
    for item, t in items:
        w = low(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            phrases.setdefault(tuple(w[k:k + n]), set()).update([] if item is None else [str(item)])
    for block in (decontam.BLOCK_BYTES, 40):
        found, (n_words, spans, names) = decontam.find_contamination(docs, bench, block_bytes=block)
        found = found.withColumn("hit", decontam.n_hit(spans))
        for r in found.collect():
            w = low(texts[r.doc_id])
            hit, ids = [False] * len(w), set()
            for n in {len(p) for p in phrases}:
                for k in range(len(w) - n + 1):
                    if tuple(w[k:k + n]) in phrases:
                        hit[k:k + n] = [True] * n
                        ids |= phrases[tuple(w[k:k + n])]
            assert (r[n_words], r.hit, r[names]) == (len(w), sum(hit), sorted(ids)), r.doc_id
    assert decontam.decontaminate(empty, bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.without_contaminated(docs, bench).columns == docs.columns


def test_shards(docs, empty, texts):
    out = shards.shard(docs, bucket_bytes=5000).collect()
    assert Counter(r.doc_id for r in out) == Counter(list(texts))
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.grown_shard in (r.shard, 8)
    for k in range(8):
        slots = sorted(r.slot for r in out if r.shard == k)
        assert slots == list(range(len(slots)))
    again = {(r.doc_id, r.slot) for r in shards.shard(docs.repartition(3), bucket_bytes=5000).collect()}
    assert again == {(r.doc_id, r.slot) for r in out}
    assert shards.shard(empty).count() == 0


def test_shards_shuffle_records_once(spark, docs):
    """Slots are found without a second shuffle of the records, whatever the sizes are estimated at."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = shards.shard(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
    slots = {k: sorted(r.slot for r in out.collect() if r.shard == k) for k in range(8)}
    assert all(found == list(range(len(found))) for found in slots.values())


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 300, None: 0, "é": 40}
    budget, names = 1.5 * sum(sizes.values()), sorted((s for s in sizes if s), key=lambda s: s) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rate = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * rate > 2 * sizes[s]}
        for s in above or open_:
            target[s] = 2 * sizes[s] if above else weight[s] * rate
        open_ -= above or open_
    found = mixture.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: round(r.target, 6) for r in found} == {s: round(t, 6) for s, t in target.items()}


def test_mix(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 120)), rng.choice("aaaaabc")) for i in range(9000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixture.mix(table).collect()
    assert {r.doc_id: r["size"] for r in out} == {i: len(words_of(t)) for i, t, _ in rows}
    assert {r.copies for r in out} <= {0, 1, 2}
    for name in "abc":
        mine = [r for r in out if r.source == name]
        assert abs(sum(r.copies * r["size"] for r in mine) / mine[0].target - 1) < 0.01
    assert sorted(r.copies for r in mixture.mix(table.repartition(5)).collect()) == sorted(r.copies for r in out)
    mixed = mixture.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in mixture.mix(docs).collect())
    assert mixture.mixed(empty).count() == 0


def test_warc(spark, folder):
    html = ["<p>é</p>", None, "", "<p>é</p>", "WARC/1.1\r\n\r\n\r\n", "long " * 50_000, "<p>é</p>"]
    rows = [(k, f"http://x/{k}\r\n" if k else None, h) for k, h in enumerate(html)]
    out = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: r.payload_bytes for k, r in out.items()} == {k: len((h or "").encode()) for k, h in enumerate(html)}
    assert {k: (r.record_type, r.refers_to) for k, r in out.items() if r.refers_to is not None or r.record_type != "response"} == {
        0: ("revisit", 6), 1: ("revisit", 2), 3: ("revisit", 6)}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_fingerprints(docs, empty, texts):
    found = by_id(fingerprint.fingerprints(docs, parts=5))
    order = sorted(texts)
    for k, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if edited == text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert found[7].fingerprint == found[8].fingerprint
    assert fingerprint.fingerprints(empty).count() == 0


def test_url_rules(spark):
    urls = {1: "http://A.Example.NET/en/1", 2: "https://net/x", 3: "http://xnet/", 4: "ftp://a.org/fr/?q", 5: None, 6: "no url",
            7: "http://example.com/de/a#b", 8: "http://notexample.com/de/", 9: "http://example.net?x", 10: "a://b://c"}
    pages = spark.createDataFrame([(k, u, 1) for k, u in urls.items()], "page_id long, url string, verdict int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, labels).collect()}
    assert found == {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"), 2: ("net", "/x", "net/", "block"), 3: ("xnet", "/", None, "allow"),
        4: ("a.org", "/fr/", "org/fr/", "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("example.com", "/de/a", "example.com/de/", "block"), 8: ("notexample.com", "/de/", None, "allow"),
        9: ("example.net", "", None, "allow"), 10: ("b:", "//c", None, "allow")}


def test_url_mining(spark):
    rows = [(k, f"http://{'bad' if k % 4 == 0 else 'fine'}.site.com/{'win' if k % 4 == 0 else 'news'}/{k}") for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(300)], "doc_id long, quality int, toxic int")
    found = {r.page_id: r.verdict for r in urlfilter.judge(pages, labels).collect()}
    assert found == {k: "block" if k % 4 == 0 else "allow" for k in range(400)}


def test_secrets(spark, docs, empty):
    rng = random.Random(9)
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    plain = lambda: "-".join(rng.choices(["section", "chapter", "report", "2021", "v10"], k=5))
    rows = [(k, f"é some words token = {hexa(40)} and AKIA{hexa(20).upper()} more" if k % 2 else f"see {plain()} in the text") for k in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "Password: abc api-key='x' API_KEY= \"abcdef\""), (1003, "x " * 50_000 + "secret=longenough")]
    out = {r.doc_id: r for r in secretscan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, text in rows:
        base = secretscan.pattern_spans((text or "").encode())
        assert (out[k].n_assign, out[k].n_access, out[k].n_hex) == tuple(sum(s[0] == kind for s in base) for kind in secretscan.KINDS)
        spans = set(out[k].spans.split(",")) - {""}
        assert {s for s in spans if not s.startswith("learned")} >= {f"{kind}:{len(text.encode()[:a].decode())}:{len(text.encode()[:b].decode())}" for kind, a, b in base}
    assert sum("learned" in out[k].spans for k in range(0, 600, 2)) < 15
    assert out[1002].n_assign == 1 and out[1000].spans == "" and out[1003].n_assign == 1
    assert secretscan.scan(empty).count() == 0


def test_network_learns_on_held_out():
    rng = random.Random(4)
    line = lambda s: s.rjust(charcnn.LEFT + len(s), "\0").ljust(charcnn.SIZE, "\0")[:charcnn.SIZE]
    secret = [line("".join(rng.choices("0123456789abcdef", k=32))) for _ in range(400)]
    other = [line("-".join(rng.choices(["alpha", "beta", "2020", "page"], k=6))) for _ in range(400)]
    x, y = charcnn.encoded(secret + other), np.repeat([1.0, 0.0], 400)
    held = np.arange(800) % 4 == 0
    model = charcnn.CharCNN(1)
    model.fit(x[~held], y[~held], 3, 1)
    model.calibrate(x[held], y[held], 0.98)
    said = model.probability(x[held]) >= model.threshold
    assert said[y[held] == 1].mean() >= 0.97 and said[y[held] == 0].mean() <= 0.03


def test_network_learns_from_every_window(spark, monkeypatch):
    """All windows are in a pass once, in blocks; the threshold is the exact one of all that are held out."""
    rng = random.Random(6)
    line = lambda s: s.rjust(charcnn.LEFT + len(s), "\0").ljust(charcnn.SIZE, "\0")[:charcnn.SIZE]
    secret = [line("".join(rng.choices("0123456789abcdef", k=32))) for _ in range(5_000)]
    other = [line("-".join(rng.choices(["alpha", "beta", "2020", "page"], k=4)) + str(k)) for k in range(700)]
    findings = spark.createDataFrame([(w, True) for w in secret] + [(w, False) for w in other] + [(w, False) for w in other[:50]], "window string, found boolean")
    passes = spark.sparkContext.accumulator(0)
    plain = secretscan._trained

    def counted(*given):
        trained = plain(*given)
        def count(block):
            passes.add(block.num_rows)
            return trained(block)
        return count

    monkeypatch.setattr(secretscan, "EPOCHS", 2)
    monkeypatch.setattr(secretscan, "BLOCK", 700)
    monkeypatch.setattr(secretscan, "_trained", counted)
    model = secretscan.train(findings, 0.9)
    held = {r.window for r in findings.select("window").distinct().filter(F.pmod(F.xxhash64("window", F.lit(secretscan.SEED)), F.lit(secretscan.FOLDS)) == 0).collect()}
    assert passes.value == 2 * (5_700 - len(held))
    said = np.sort(model.probability(charcnn.encoded([w for w in secret if w in held])))
    assert abs(model.threshold - said[int(np.floor((1 - 0.9) * len(said)))]) < 1e-9
    assert (model.probability(charcnn.encoded([w for w in other if w in held])) >= model.threshold).mean() <= 0.05
    again = secretscan.train(findings.repartition(7), 0.9)
    assert (model.weights() == again.weights()).all()


def test_quality(spark, empty):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 7))) for _ in range(200)]
    good = lambda: " ".join(rng.choices(vocabulary, k=60)).capitalize() + "."
    junk = lambda: " ".join("".join(rng.choices("ABCXYZ!!%%$#", k=6)) for _ in range(60))
    rows = [(k, junk() if k % 10 == 0 else good(), "xx", 1) for k in range(1000)] + [(2000, None, "xx", 1), (2001, "", None, 1), (2002, good(), "rare", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity int")
    labels = spark.createDataFrame([(k, int(k % 10 != 0), 0) for k in range(500)] + [(None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.without_rejected(table, labels).collect()}
    assert not kept & set(range(0, 1000, 10)) and {2000, 2001, 2002} <= kept
    assert len(kept & {k for k in range(1000) if k % 10}) >= 880
    assert quality.without_rejected(table, labels).columns == table.columns
    assert quality.classify(table, labels.limit(0)).filter("kept").count() == 1003
    assert quality.classify(empty, labels).count() == 0


def test_probabilities_sum_to_one(spark, folder):
    rng = random.Random(1)
    counts = Counter()
    for _ in range(300):
        code = 0
        for k in range(4):
            code = code * quality.SYMBOLS + rng.randrange(2, 6)
        counts[code] += 1
    table = spark.createDataFrame([("m", c, n) for c, n in counts.items()], "model string, code long, n long")
    context = next(iter(counts)) // quality.SYMBOLS
    wanted = spark.createDataFrame([("m", context * quality.SYMBOLS + k) for k in range(quality.SYMBOLS)], "model string, code long")
    total = sum(np.exp(r.logp) for r in quality.probabilities(table, wanted, folder).collect())
    assert abs(total - 1) < 1e-9


def test_quality_tells_characters_apart(spark):
    """A script of more letters than 62: each is a symbol of its own."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + k) for k in range(3000)]
    words = ["".join(rng.choices(letters, k=3)) for _ in range(400)]
    good = lambda: "".join(rng.choices(words, k=60))
    shuffled = lambda: "".join(rng.choices(letters, k=180))
    rows = [(k, good() if k < 800 else shuffled(), "zh") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(500)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.classify(docs, labels).collect() if r.kept}
    assert not kept & set(range(800, 900)) and len(kept) >= 780


def _perplexity(counts, text, order=quality.ORDER):
    """Plain Kneser-Ney over UTF-16 units, units before the text being -1."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    d = {}
    for k, level in levels.items():
        of = Counter(level.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else None
        d[k] = []
        for c in (1, 2, 3):
            fitted = c - (c + 1) * y * of[c + 1] / of[c] if y is not None and of[c] else -1
            d[k].append(fitted if 0 < fitted < c else 0.5 + 0.25 * (c - 1))

    sums = {k: Counter() for k in levels}
    taken = {k: Counter() for k in levels}
    for k, level in levels.items():
        for g, n in level.items():
            sums[k][g[:-1]] += n
            taken[k][g[:-1]] += min(n, d[k][min(n, 3) - 1])

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / quality.SYMBOLS
        n, total = levels[k].get(g, 0), sums[k].get(g[:-1])
        if not total:
            return low
        return (n - min(n, d[k][min(n, 3) - 1]) if n else 0) / total + taken[k][g[:-1]] / total * low

    grams = _units(text, order)
    return float(np.exp(-np.mean([np.log(p(g)) for g in grams])))


def _units(text, order=quality.ORDER):
    u = [-1] * (order - 1) + list(np.frombuffer(text.encode("utf-16-le"), np.uint16).tolist())
    return [tuple(u[k:k + order]) for k in range(len(u) - order + 1)]


def test_quality_equals_brute_force(spark):
    rng = random.Random(3)
    alphabet = [chr(0x61 + k) for k in range(26)] + [chr(0x3040 + k) for k in range(80)] + ["😀", "𠀀", " "]
    rows = [(k, "".join(rng.choices(alphabet, weights=range(1, len(alphabet) + 1), k=rng.randint(1, 300))), "ja") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    held = {r.doc_id for r in docs.filter(f"pmod(xxhash64(doc_id, {quality.SEED}), {quality.FOLDS}) = 0").collect()}
    counts = Counter(g for k, text, _ in rows if k < 200 and k not in held for g in _units(text))
    out = {r.doc_id: r.perplexity for r in quality.classify(docs, labels).collect()}
    for k, text, _ in rows[::7]:
        assert out[k] == pytest.approx(_perplexity(counts, text), rel=1e-6)


def test_quality_thresholds_by_language(spark):
    rng = random.Random(12)
    text = lambda letters: " ".join("".join(rng.choices(letters, k=4)) for _ in range(12))
    rows = [(k, text("abcde") if k % 6 else text("абвгдежзик"), "aa" if k % 6 else "bb") for k in range(300)] + [(900 + k, text("xyz"), "cc") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    held = {r.doc_id for r in docs.filter(f"doc_id < 200 AND pmod(xxhash64(doc_id, {quality.SEED}), {quality.FOLDS}) = 0").collect()}
    out = quality.classify(docs, labels).collect()
    for lang in ("aa", "bb"):
        assert {r.threshold for r in out if r.lang == lang} == {max(r.perplexity for r in out if r.lang == lang and r.doc_id in held)}
    assert all(r.kept and r.threshold is None for r in out if r.lang == "cc")
