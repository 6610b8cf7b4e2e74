"""Filter audit, token alignment and the pivot join on awkward rows, held against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import align, audit, jaccard

SPACE = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(SPACE, text or "")


# --- filter interaction audit ---------------------------------------------------------------------

LONG = " ".join(f"w{k}" for k in range(210))
AUDITED = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG + " #", "a"), (4, LONG.upper(), "b"), (5, "same " * 250, "b"), (6, None, "b"), (7, "", "b"),
    (8, "x $ y", None), (9, "x $ y", ""), (9, "x $ y", ""), (None, "x $ y", "a"), (None, LONG, None), (2, LONG, "a"), (1, LONG, "c"),
    (10, " \x0b\x1f" + LONG + "\r\n", "c"), (11, "É" * 300, "c"), (12, "A" * 3 + "b" * 147, "c"), (13, "same " * 199 + "é same", "d"),
    (14, " ".join(["u", "v"] * 100 + ["w"]), "d"), (15, LONG + "|", "a"), (16, "same " * 250, "a")]
LABELLED = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (5, 0, None), (9, 1, 1), (16, 1, 0), (None, 1, 1), (99, 1, 1)]


def audited(rows, labels):
    """The report by running all orders document by document."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, part in rows:
        text = text or ""
        words = words_of(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i}
        parts.setdefault(part or "", []).append((fails, i in good, i in toxic))
    out, totals = {}, Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, start=1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                totals[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(d[0][f] for d in docs) - len(gone),
                    sum(d[0][f] and sum(d[0].values()) == 1 for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_running_all_orders(spark):
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in AUDITED], "doc_id long, text string, source string, mask int, `key` int, First string")
    labels = spark.createDataFrame([(*r, "y") for r in LABELLED], "doc_id long, quality int, toxic int, text string")
    found = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit(docs, labels).collect()}
    assert found == audited(AUDITED, LABELLED)
    assert len(found) == 5 * 600
    turned = spark.createDataFrame([(*r, 1, 2, "x") for r in AUDITED[::-1]], docs.schema).repartition(3)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit(turned, labels).collect()} == found
    assert audit.audit(docs.limit(0), labels).count() == 0
    alone = audit.audit(docs, labels.limit(0))
    assert alone.filter("good_lost + toxic_lost > 0").isEmpty() and alone.count() == 5 * 600


@pytest.mark.parametrize("n", [2, 3, 5])
def test_least_squares_give_shapley_values(n):
    rng = random.Random(n)
    v = [0] + [rng.randint(0, 1000) for _ in range((1 << n) - 1)]
    weights, bottom = audit.shapley_weights(n)
    for i in range(n):
        total = 0
        orders = list(permutations(range(n)))
        for order in orders:
            before = sum(1 << j for j in order[:order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert Fraction(sum(w * x for w, x in zip(weights[i], v)), bottom) == Fraction(total, len(orders))


# --- cross-tokenizer alignment --------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabularies():
    return [align.ByteLevel(f"{align.FOLDER}/{align.BYTE_LEVEL}"), align.Pieces(f"{align.FOLDER}/{align.PIECES}")]


def tokens_of(vocabularies, text):
    """Both libraries on the whole text: ids and byte ends, or none."""
    in_a, in_b = vocabularies
    if not text:
        return None
    ids = [in_a.model.encode(" " + text, add_special_tokens=False).ids, in_b.model.encode(text)]
    out = []
    for k, vocabulary in zip(ids, vocabularies):
        parts = [vocabulary.bytes[i].as_py() for i in k]
        if b"".join(parts) != (" " + text).encode():
            return None
        ends, at = [], 0
        for p in parts:
            at += len(p)
            ends.append(at)
        out.append((k, ends))
    return out


def aligned_by_hand(vocabularies, texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text."""
    linked, written = [], []
    for text in texts:
        sides = tokens_of(vocabularies, text)
        if sides is None:
            linked.append(None)
            written.append((0, 0, 0, 0, ""))
            continue
        (a, ends_a), (b, ends_b) = sides
        pairs = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
                 if max(([0] + ends_a)[i], ([0] + ends_b)[j]) < min(ends_a[i], ends_b[j])]
        cuts, low, groups = sorted(set(ends_a) & set(ends_b)), 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(x) for x, e in zip(ids, ends) if low < e <= cut) for ids, ends in sides))
            low = cut
        linked.append(pairs)
        written.append((len(a), len(b), len(cuts), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for pairs in linked if pairs for p in set(pairs))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for pairs, (n_a, n_b, n_groups, n_links, digest) in zip(linked, written):
        pairs = pairs or []
        out.append((n_a, n_b, n_groups, n_links, sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs), digest))
    return out


TEXTS = [None, "", " ", "  ", "a", "Hello  world\n\tüñí <|endoftext|> ab\x00 <0x41> é  ", "▁x", "no ▁ here", "  a 　b", "   lead",
         "x" * 700, "a\n b \n c", " <s> </s> <unk>", "𝔘𝔫 😀👍🏽 日本語 テスト", "don't I'll 123 4567", "Hello world", "Hello world", "hello, world. Hello",
         "tail \x85 x y", "the cat and the hat " * 30, "internationalisation of counterrevolutionaries " * 5]


def test_alignment_equals_plain_python(spark, vocabularies, monkeypatch):
    docs = spark.createDataFrame([(k if k % 5 else None, t, "x", 7) for k, t in enumerate(TEXTS)], "doc_id long, text string, block string, n_a int")
    expected = aligned_by_hand(vocabularies, TEXTS)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found, pairs = align.align(docs.coalesce(1))
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(expected)
    assert sorted(tuple(r[c] for c in columns) for r in align.alignments(docs.repartition(5)).collect()) == sorted(expected)
    named = {r["doc_id"]: tuple(r[c] for c in columns) for r in align.alignments(docs).collect() if r["doc_id"] is not None}
    assert named == {k: e for k, e in enumerate(expected) if k % 5}
    assert pairs.groupBy("a").agg({"n": "max"}).count() == pairs.filter("best").select("a").distinct().count()
    assert align.alignments(docs.limit(0)).count() == 0
    monkeypatch.setattr(align, "BLOCK", 50)
    monkeypatch.setattr(align, "KNOWN", 3)
    assert sorted(tuple(r[c] for c in columns) for r in align.alignments(docs.coalesce(2)).collect()) == sorted(expected)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\tab'1é<|>_. ▁")), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=4))
def test_pieces_give_the_tokens_of_whole_texts(vocabularies, texts):
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    out = pa.Table.from_batches(list(align._block(0, batch, align.Encoder(vocabularies)))).slice(0, len(texts)).to_pylist()
    hand = aligned_by_hand(vocabularies, texts)
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in out] == [(*h[:4], h[6]) for h in hand]


def test_pairs_beyond_two_bytes_and_wide_numbers(spark, vocabularies, monkeypatch):
    docs = pa.table({"n_a": pa.array([1], pa.int64()), "links": pa.array([pa.array([0, 70_000], pa.uint32()).to_numpy().tobytes()])})
    found = pa.table({"number": pa.array(range(70_001)), "n": pa.array([2] * 70_001), "best": pa.array([0] * 70_000 + [1])})
    assert align._summed(docs, found).to_pylist() == [{"n_a": 1, "n_best": 1, "count_sum": 4}]


# --- Jaccard join by pivots -----------------------------------------------------------------------

def components_of(texts, width, percent=80):
    sets = {}
    for i, t in texts.items():
        w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.fixture(scope="module")
def family():
    """Chains of near copies, a crowd around one text, shared passages, short and odd texts."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    texts = {0: None, 1: "", 2: " \t", 3: "one", 4: "One two three four", 5: "one two three four", 6: "one two three four five", 7: "x" * 50_000}
    passage = rng.choices(vocabulary, k=60)
    for chain in range(4):
        words = rng.choices(vocabulary, k=rng.choice((30, 80, 150)))
        for _ in range(14):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(words)
    centre = rng.choices(vocabulary, k=100)
    for k in range(60):
        words = list(centre)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(100)] = f"n{k}"
        texts[len(texts)] = " ".join(words)
    for k in range(40):
        texts[len(texts)] = " ".join(passage + rng.choices(vocabulary, k=rng.choice((3, 8, 15, 40))))
        texts[len(texts)] = " ".join(rng.choices(vocabulary, k=4) + passage[:rng.randint(5, 30)])
    texts[len(texts)] = " ".join(rng.choices(vocabulary, k=8000))
    texts[len(texts)] = texts[len(texts) - 1] + " more"
    return texts


@pytest.mark.parametrize("rounds, width, percent", [(1, 5, 80), (3, 5, 80), (6, 3, 80), (2, 5, 60)])
def test_jaccard_join_equals_brute_force(spark, family, rounds, width, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 7)
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in family.items()], "doc_id long, text string, node int, root string").repartition(3)
    out, links = jaccard.jaccard_join(docs, width, percent, rounds)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == components_of(family, width, percent)
    assert links.filter(f"100 * both < {percent} * either OR a = b").isEmpty()


def test_jaccard_join_repeated_null_and_no_rows(spark):
    text = "a b c d e f g"
    rows = [(1, text), (1, "h i j k l m"), (1, text), (2, text), (3, "h i j k l m"), (None, text), (4, "q r s t u v"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.joined(docs).collect())
    assert out == [(0, 0, 0), (0, 3, 0), (1, 2, 1), (1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 2, 1), (4, 2, 4)]
    assert jaccard.joined(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard.jaccard_join(docs, percent=100)


def test_pivot_of_a_crowd_is_its_middle(spark, monkeypatch):
    """Of texts with more and less edits of one, that one is the pivot of most: it is linked with more than any other."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    centre = rng.choices(vocabulary, k=150)
    texts = {}
    for k in range(200):
        words = list(centre)
        for at in rng.sample(range(150), min(k // 17, 12)):
            words[at] = rng.choice(vocabulary)
        texts[199 - k] = " ".join(words)
    looked = []
    plain = jaccard._sketched
    monkeypatch.setattr(jaccard, "_sketched", lambda *given: looked.append(given) or plain(*given))
    out = jaccard.joined(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == components_of(texts, 5)
    pairs, points, _ = looked[0]
    pivot = pairs.groupBy("b").count().orderBy("count", ascending=False).first()["b"]
    assert texts[points.filter(f"node = {pivot}").first()["first"]] == " ".join(centre)
