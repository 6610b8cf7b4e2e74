"""The fingerprint digest and the secret patterns against plain Python that shares no code with them."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from demandloom.llm import fingerprint, secretscan

GAP = [[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]]


def bucket(a, b, c, kind):
    code = (a | b << 8 | c << 16) + (kind << 24)
    code = code * 0x9E3779B1 % 2 ** 32
    code = (code ^ code >> 15) * 0x85EBCA77 % 2 ** 32
    return code >> 24


def digest(text):
    """Length class, both quartile ratios and the quarter of each of the 256 buckets."""
    raw, counts = (text or "").encode(), [0] * 256
    for i in range(len(raw)):
        for kind, (second, third) in enumerate(((1, 2), (1, 3), (2, 3))):
            if i + third < len(raw):
                counts[bucket(raw[i], raw[i + second], raw[i + third], kind)] += 1
    q1, q2, q3 = (sorted(counts)[256 * k // 4 - 1] for k in (1, 2, 3))
    length = min(255, 1 + math.floor(math.log(len(raw)) / math.log(1.25))) if raw else 0
    top = max(q3, 1)
    return length, q1 * 15 // top, q2 * 15 // top, [(n > q1) + (n > q2) + (n > q3) for n in counts]


def written(d):
    length, first, second, quarters = d
    body = bytes(quarters[k] << 6 | quarters[k + 1] << 4 | quarters[k + 2] << 2 | quarters[k + 3] for k in range(0, 256, 4))
    return (bytes([length, first << 4 | second]) + body).hex()


def alike(a, b):
    gap = sum(GAP[x][y] for x, y in zip(a[3], b[3])) + sum(abs(x - y) for x, y in zip(a[:3], b[:3]))
    return max(0.0, 1 - gap / (256 * sum(map(sum, GAP)) / 16))


def test_digest_and_likeness_equal_brute_force(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdefghijklmnoprstuéß日", k=rng.randint(2, 9))) for _ in range(200)]
    texts = [None, "", "a", "ab", "abc", "aaaa", "x" * 3000] + [" ".join(rng.choices(vocabulary, k=n)) for n in (3, 10, 40, 120, 121, 500, 900)]
    texts += [texts[-1], texts[-2].replace("a", "o", 3)]
    docs = spark.createDataFrame([(k * 3, t, "z", 1) for k, t in enumerate(texts)], "doc_id long, text string, fingerprint string, part int").repartition(4)
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(docs, parts=3).collect()}
    for k, text in enumerate(texts):
        text, after = text or "", texts[(k + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        own, new, following = digest(text), digest(edited), digest(after)
        r = found[3 * k]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), written(own), written(new))
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(own, new)) and r["near_next"] == pytest.approx(alike(own, following))


def base_spans(text):
    """Leftmost non-overlapping matches of each kind on code points, those too short dropped."""
    out = []
    name = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(name + "[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def test_base_columns_equal_plain_patterns(spark):
    rng = random.Random(2)
    run = lambda letters, n: "".join(rng.choices(letters, k=n))
    pieces = [lambda: "password=" + run("abcXYZ019+/_.=-", rng.randint(1, 12)), lambda: "Api_Key' :  \"" + run("abc012", rng.randint(4, 9)) + '"',
              lambda: "SECRET:token=" + run("abc", 7), lambda: "AKIA" + run("ABCDEF0123", rng.randint(10, 25)), lambda: run("0123456789abcdef", rng.randint(18, 40)),
              lambda: "éü日本 ", lambda: "word ", lambda: "passwd\t=abcdefgh ", lambda: "apikey=ſecret ", lambda: "toKen=abcdefg ", lambda: "\n"]
    texts = [None, "", "token=", "token=abcdef", "password=abcde"] + ["".join(rng.choice(pieces)() + rng.choice(["", " ", "é"]) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(3, texts[3], 2), (3, texts[3], 2), (None, texts[10], 3)]
    found = secretscan.scan(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[r["doc_id"]] if r["doc_id"] is not None else texts[10]
        base = base_spans(text or "")
        joined = [f"{kind}:{start}:{end}" for kind, start, end in base]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("learned")] == joined
