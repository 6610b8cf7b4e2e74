"""Filter interaction audit: what each filter removes in every order in which the filters could run.

A filter fails a document or not, whatever ran before it. So everything that an order of filters
does follows from one table: how many documents each coalition (set of filters) removes. Documents
are counted by part and by the set of filters that they fail, at most 2**n rows a part; from these
come the removals v(S) of all coalitions S, a count each of documents, good and toxic ones. A step
that applies f after S removes v(S + f) - v(S).

A filter's Shapley value, its removals averaged over all orders, is the solution of a weighted least
squares problem: fit v(S) by the sum of a weight per member of S, each coalition neither empty nor
full weighted by the Shapley kernel, the weights held to sum to v(all). `shapley_weights` solves its
normal equations in rational numbers for every table at once: the solution is linear in v, so each
filter's value is a row of integers over one denominator, applied to the part's table.

Documents: null texts are as empty ones; a null part is the empty string; an empty table has no
parts and so no rows. Labels: a document labelled several times is good or toxic if one label says
so; null labels say nothing. Repeated rows are documents of their own, and rows that share the
smallest doc_id of a text all count as its first ones. A null doc_id has no smaller one, is no
smaller one of others and has no label.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared

#: each order is a row of every part, so n! rows: the same bound keeps the 2**n coalitions small
MOST_FILTERS = 7
_SPACES = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order."""
    bare = F.btrim(text, F.lit(_SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def text_filters(text: Column, words_: Column) -> dict[str, Column]:
    """Four filters on a text that is not null and its words: too short, repetitive, shouting, odd signs."""
    n = F.size(words_).cast("long")
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words_)).cast("long") < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of matrix X = right, by elimination."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    n = len(rows)
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [row[n:] for row in rows]


def shapley_weights(n: int) -> tuple[list[list[int]], int]:
    """Integers w and their denominator: filter i's Shapley value is sum(w[i][S] * v[S]) / denominator.

    Normal equations of the constrained least squares problem, with a multiplier for the
    constraint: [X'WX 1; 1' 0] [phi; m] = [X'W v; v(all)], solved for each unit table v.
    """
    full = (1 << n) - 1
    inside = {s: [i for i in range(n) if s >> i & 1] for s in range(full + 1)}
    kernel = {s: Fraction(n - 1, comb(n, len(m)) * len(m) * (n - len(m))) for s, m in inside.items() if 0 < len(m) < n}
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (full + 1) for _ in range(n + 1)]
    for s, weight in kernel.items():
        for i in inside[s]:
            right[i][s] += weight
            for j in inside[s]:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n][full] = Fraction(1)
    phi = _solved(matrix, right)[:n]
    bottom = lcm(*[x.denominator for row in phi for x in row])
    return [[int(x * bottom) for x in row] for row in phi], bottom


def failures(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask (bit k for a failure of the k-th of ABCDE), good and toxic of every document.

    E is failed by a text that a smaller doc_id has too, anywhere in the table. Equal texts are told
    by their SHA-256, the first ones by (hash, smallest doc_id): a join on both keys has no hot
    one, however many copies a text has.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    found = text_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(found.values())), F.lit(0))
    # a null doc_id meets nothing: its key is dealt by text, so that such rows are not one hot key
    rows = rows.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("text"))
    rows = shared.stored(rows.withColumn("key", F.coalesce(F.col("doc").cast("long"), F.xxhash64("text", "part"))),
                         shared.workspace(docs.sparkSession, "audit"))
    first = rows.groupBy("text").agg(F.min("doc").alias("first")).filter("first IS NOT NULL")
    first = first.select(F.col("text").alias("text_"), F.col("first").cast("long").alias("first"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))])
    named = F.col("doc").isNotNull()
    rows = rows.join(marks, (F.col("key") == F.col("labelled")) & named, "left")
    rows = rows.join(first, (F.col("key") == F.col("first")) & (F.col("text") == F.col("text_")) & named, "left")
    copy = F.when(named & F.col("first").isNull(), F.lit(1 << len(found))).otherwise(0)
    return rows.select("part", (F.col("mask") + copy).alias("mask"),
                       *[F.coalesce(m, F.lit(False)).alias(m) for m in ("good", "toxic")])


def coalitions(failed: DataFrame, n: int) -> DataFrame:
    """A row a part: docs and toggled(coalition -> docs, good and toxic ones that it removes), all 2**n of them."""
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    counted = failed.groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(F.col("toxic"), 1)).alias("toxic"))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    tables = counted.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1)))).groupBy("part", "coalition").agg(
        F.sum("docs").alias("all"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("docs", "good", "toxic")])
    ordered = F.array_sort(F.collect_list(F.struct("coalition", "docs", "good", "toxic")))
    return tables.groupBy("part").agg(F.max("all").alias("docs"), ordered.alias("removals"))


def interactions(tables: DataFrame, names: str) -> DataFrame:
    """Every step of every order of the filters, from the coalition tables of `coalitions`.

    names: a letter for each filter, in the order of its bit.
    """
    n = len(names)
    weights, bottom = shapley_weights(n)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])

    def bit_of(step: Column | str) -> Column:
        letter = F.substr("filter_order", step, F.lit(1))
        return F.call_function("shiftleft", F.lit(1), F.call_function("instr", F.lit(names), letter) - 1)

    earlier = sum((F.when(F.col("step") > j, bit_of(F.lit(j))).otherwise(0) for j in range(1, n)), F.lit(0))

    def at(coalition: Column, field: str = "docs") -> Column:
        return F.get("removals", coalition)[field]

    def value(row: list[int]) -> Column:
        """The filter's removals in all n! orders together, times the denominator."""
        weighed = F.zip_with(F.col("removals"), F.array(*[F.lit(x).cast("long") for x in row]), lambda r, w: r["docs"] * w)
        return F.lit(factorial(n)).cast("long") * F.aggregate(weighed, F.lit(0).cast("long"), lambda a, b: a + b)

    tables = tables.withColumn("values", F.array(*[value(row) for row in weights]))
    rows = (tables.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
            .withColumns({"bit": bit_of("step"), "earlier": earlier}).withColumn("after", F.col("earlier").bitwiseOR(F.col("bit"))))
    removed = at(F.col("after")) - at(F.col("earlier"))
    full = (1 << n) - 1
    return rows.select(
        "part", "filter_order", "step", (F.col("docs") - at(F.col("after"))).alias("kept"), removed.alias("removed"),
        (at(F.col("bit")) - removed).alias("redundant"), (at(F.lit(full)) - at(F.lit(full) - F.col("bit"))).alias("unique_fails"),
        (at(F.col("after"), "good") - at(F.col("earlier"), "good")).alias("good_lost"),
        (at(F.col("after"), "toxic") - at(F.col("earlier"), "toxic")).alias("toxic_lost"),
        F.expr(f"values[instr('{names}', substr(filter_order, step, 1)) - 1] div {bottom}L").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The five filters ABCDE over docs(doc_id, text, part, ...) and labels(doc_id, quality, toxic)."""
    return interactions(coalitions(failures(docs, labels, part), 5), "ABCDE")
