"""URL filters: stated host and path rules, and rules mined from labelled pages by FP-growth.

The tokens of a labelled URL and its label make a transaction. FP-growth finds token combinations that
go with bad pages; those with enough support and confidence block. Each mined rule is filed under
the rarest of its tokens; a URL meets only the rules filed under its own tokens.
All steps are DataFrame operations and Spark's own FP-growth.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import ascii_lower, staged

# Stated rules as (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
BAD = "label=bad"
GOOD = "label=good"
#: Least number of bad pages that a mined combination must occur in, whatever the size of the corpus, and least share of bad pages among its pages.
MIN_PAGES, MIN_CONFIDENCE = 12, 0.8
#: Up to this many mined rules go to every executor; more are joined by a shuffle.
BROADCAST_RULES = 20_000

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def document_of(url: Column) -> Column:
    """The doc_id of a page: the number that is the last segment of its path, an ending like ``.html`` aside; else null."""
    return F.regexp_extract(path_of(url), r"/([0-9]+)(?:\.[A-Za-z0-9]+)?/?$", 1).try_cast("long")


def stated(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """(verdict, rule) of the longest rule that fits host or a parent domain and begins the path; else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: scheme, host, domains it belongs to, first label, path segments, query keys.

    Runs of digits count as one digit in paths and queries, where they number pages; hosts keep theirs.
    """
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)

    def numbered(parts: Column) -> Column:
        return F.transform(parts, lambda p: F.regexp_replace(p, "[0-9]+", "0"))

    def named(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))

    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1))
    return F.array_distinct(
        F.concat(
            named("scheme=", F.array(F.regexp_extract(url, "(?s)^(.*?)://", 1))),
            named("domain=", F.array(F.substring_index(host, ".", -2), F.substring_index(host, ".", -3), host)),
            named("label=", F.transform(F.slice(F.split(host, "\\."), 1, 1), lambda p: F.concat(F.lit("host:"), p))),
            named("path=", numbered(F.split(path, "/"))),
            named("query=", numbered(keys)),
            F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
        )
    )


def mined_rules(pages: DataFrame, labels: DataFrame, min_support: float | None = None, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(key, items, confidence) of the token combinations that go with bad pages.

    All pages of labelled documents are transactions (a page is bad if its document has quality 0 or toxic 1; null labels
    say nothing, nor do pages without a document's number in their path). A rule
    is dropped if a part of its tokens is a rule already. ``key`` is the rarest of its tokens. A rule takes ``MIN_PAGES`` bad
    pages, so that one bad host is found in a corpus of any size; ``min_support`` asks for a share of the transactions instead.
    """
    says = labels.select("doc_id", ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    says = says.where("doc_id is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    items = F.concat(tokens_of(F.col("url")), F.array(F.when(F.col("bad"), F.lit(BAD)).otherwise(F.lit(GOOD))))
    transactions = staged(pages.select("url", document_of(F.col("url")).alias("doc_id")).join(says, "doc_id").select(F.array_distinct(items).alias("items")), "transactions")
    schema = "key string, items array<string>, confidence double"
    spark = pages.sparkSession
    n = transactions.count()
    if not n:
        return spark.createDataFrame([], schema)
    if min_support is None:
        min_support = min(1.0, (MIN_PAGES - 0.5) / n)  # FP-growth rounds the number up
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(transactions)
    found = model.associationRules.where(F.col("consequent")[0] == BAD).select(F.array_sort("antecedent").alias("items"), "confidence")
    rules = staged(found.where(~F.array_contains("items", GOOD)), "mined-rules")
    single = staged(model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq"), "token-counts")
    numbered = rules.withColumn("rule", F.xxhash64("items"))
    rarest = (
        numbered.select("rule", "items", "confidence", F.explode("items").alias("token")).join(single, "token")
        .groupBy("rule").agg(F.min(F.struct("freq", "token")).alias("r"), F.first("items").alias("items"), F.first("confidence").alias("confidence"))
        .select("rule", F.col("r.token").alias("key"), "items", "confidence")
    )
    rarest = staged(rarest, "rule-index")
    # A smaller rule is found through its own rarest token, which the larger one must have too.
    wider = rarest.select("rule", "items", F.explode("items").alias("key")).alias("l").join(rarest.alias("s"), "key")
    covered = wider.where((F.col("l.rule") != F.col("s.rule")) & (F.size("s.items") < F.size("l.items")) & (F.size(F.array_except("s.items", "l.items")) == 0))
    kept = rarest.join(covered.select(F.col("l.rule").alias("rule")).distinct(), "rule", "left_anti")
    return staged(kept.select("key", "items", "confidence"), "pruned-rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct token sets (``tokens``) that meet a mined rule, with the highest confidence."""
    sets = urls.select("tokens").distinct()
    if rules.count() <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    hits = sets.select("tokens", F.explode("tokens").alias("key")).join(rules, "key")
    return hits.where(F.size(F.array_except("items", "tokens")) == 0).groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, min_support: float | None = None, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) for every row of ``page_id``, ``url``.

    A stated rule that fits decides; else a URL that meets a mined rule is blocked and all others are
    allowed. Null URLs and those without ``://`` have an empty host and path. Pages are learnt from by the document
    number in their path, whatever their page_id; repeated rows are each judged; empty tables give no rows, and without labels nothing is mined.
    """
    url = F.col("url")
    urls = pages.select("page_id", url, host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    urls = staged(urls.drop("url"), "urls")
    blocked = staged(matched(urls, mined_rules(pages, labels, min_support, min_confidence)), "blocked-token-sets")
    by_rule = stated(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(blocked, "tokens", "left").withColumn("_s", by_rule).select(
        "page_id", "host", "path", F.col("_s.rule").alias("rule"), F.coalesce("_s.verdict", own).alias("verdict"), "confidence"
    )
