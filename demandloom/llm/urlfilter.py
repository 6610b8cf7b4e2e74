"""URL filters: explicit host rules, then association rules mined from labelled URLs.

A URL's tokens are its host's labels, the host's name without its first label, the path's segments
(numbers as one kind), the extension and the names of query parameters, each with its kind. Spark's
FP-growth mines the labelled URLs, each with its token set and, if bad, the item `bad`; rules that
conclude `bad` with enough support and confidence are kept, and of these only the ones that no
shorter kept rule implies. An inverted index sends each rule to its rarest token: a URL meets a
rule only through that token and is then checked for all of them.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to
`?`, `#` or the end. A null URL or one without `://` has neither and no tokens: it is allowed unless a
rule says otherwise. Explicit rules fit a host and its subdomains where the path starts with the
rule's; the longest rule wins. Rows are judged one by one, so repeated ids keep separate rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared

#: (verdict, host, path), as the contract states them
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BAD = "bad"
MIN_SUPPORT, MIN_CONFIDENCE, MAX_TOKENS = 0.0005, 0.8, 3
#: labelled URLs that a rule must rest on, however few are labelled
MIN_COUNT = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens(url: str, host_: str, path_: str) -> Column:
    """The distinct tokens of a URL."""
    labels = F.split(host_, r"\.")
    segments = F.filter(F.split(path_, "/"), lambda s: s != "")
    kinds = F.transform(segments, lambda s: F.concat(F.lit("path:"), F.regexp_replace(F.translate(s, UPPER, LOWER), "[0-9]+", "0")))
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    names = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("query:"), F.substring_index(q, "=", 1)))
    whole = F.array(F.concat(F.lit("site:"), F.regexp_replace(host_, r"^[^.]*\.", "")), F.concat(F.lit("host:"), host_))
    names_of_host = F.transform(labels, lambda s: F.concat(F.lit("label:"), s))
    return F.when(F.col(host_) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(names_of_host, whole, kinds, names)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """rules (rule_tokens, support, confidence, rare) from labelled(tokens, bad); rare: the index token."""
    folder = shared.workspace(labelled.sparkSession, "urlrules")
    items = F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens"))
    baskets = shared.stored(labelled.select(items.alias("items"), "tokens", "bad"), f"{folder}/baskets")
    least = min(1.0, max(min_support, MIN_COUNT / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    found = (model.associationRules.filter((F.col("consequent")[0] == BAD) & (F.size("antecedent") <= max_tokens))
             .select(F.sort_array("antecedent").alias("rule_tokens"), "support", "confidence"))
    found = shared.stored(found, f"{folder}/found")
    # a rule that holds a shorter kept one adds nothing; they meet in the shorter one's first token
    short = found.select(F.col("rule_tokens").alias("short"), F.col("rule_tokens")[0].alias("t"))
    long_ = found.select("rule_tokens", F.explode("rule_tokens").alias("t"))
    implied = (long_.join(short, "t").filter((F.size("short") < F.size("rule_tokens")) & (F.size(F.array_except("short", "rule_tokens")) == 0))
               .select("rule_tokens").distinct())
    kept = found.join(implied, "rule_tokens", "left_anti")
    counts = baskets.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    rare = (kept.select("rule_tokens", F.explode("rule_tokens").alias("t")).join(counts, "t")
            .groupBy("rule_tokens").agg(F.min(F.struct("n", "t"))["t"].alias("rare")))
    return shared.stored(kept.join(rare, "rule_tokens"), f"{folder}/rules")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """distinct url_tokens that hold all tokens of some rule, from urls(url_tokens)."""
    sets = urls.select("url_tokens").distinct()
    index = rules.select("rule_tokens", F.col("rare").alias("t"))
    return (sets.select("url_tokens", F.explode("url_tokens").alias("t")).join(index, "t")
            .filter(F.size(F.array_except("rule_tokens", "url_tokens")) == 0).select("url_tokens").distinct())


def explicit(host_: str, path_: str, rules=RULES) -> Column:
    """The longest explicit rule that fits, as struct(rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col(host_) == h) | F.col(host_).endswith(f".{h}")) & F.col(path_).startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages(page_id, url, ...).

    labels(doc_id, quality, toxic) labels the pages of the same id: a page of low quality or toxic
    content is bad. Ids labelled several times are bad if any label says so.
    """
    spark = pages.sparkSession
    folder = shared.workspace(spark, "urls")
    parts = pages.select("page_id", "url", host("url").alias("host"), path("url").alias("path"))
    rows = parts.select("page_id", "host", "path", explicit("host", "path", rules).alias("hit"), tokens("url", "host", "path").alias("url_tokens"))
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False))) | (F.coalesce(F.col("toxic") == 1, F.lit(False)))
    truth = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    labelled = rows.filter("size(url_tokens) > 0").join(truth, "page_id").select(F.col("url_tokens").alias("tokens"), "bad")
    mined = mine(labelled)
    found = shared.stored(matches(rows, mined), f"{folder}/matches").withColumn("matched", F.lit(True))
    return (rows.join(found, "url_tokens", "left")
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.verdict", F.when(F.col("matched"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))
