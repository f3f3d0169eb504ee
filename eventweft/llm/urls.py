"""URL filters by association rules, in DataFrame operations only.

A fixed list of (host, path) rules decides first; the longest that fits wins. For the rest, FP-growth
mines combinations of URL tokens that go with a label, from at most ``ROWS`` labelled pages: a page's
label is the verdict of the fixed list, else the ``quality`` label of its id. Rules below the least
support and confidence are pruned. Matching goes by an inverted index: every mined rule is filed under
its rarest token, the distinct sets of mined tokens that pages have are looked up there, and a rule holds
if the set has all of its tokens. The most confident rule gives the verdict; without one it is allow.

Pages with equal token sets are one row in that join; their verdict goes back to the pages by set and one of
``SALTS`` numbers, so that the pages of one set meet in several tasks. Defined results: a NULL url or one without ``://`` has an empty host and path and is
allowed unless a mined rule says otherwise; repeated rows and ties are judged alike; empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashed_sample, staged, table

#: Verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
ROWS = 50_000
SUPPORT = 0.005
CONFIDENCE = 0.8
SALTS = 16
#: Mined rules up to this number are sent to all executors; more are joined by a shuffle.
SENT_RULES = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def fitting(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(verdict, rule) of the longest fixed rule that fits, else NULL."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(own + start).alias("rule"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, the telling ones first: domain endings, folders by place, file ending,
    names before the domain, query names, mark of a fragment."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    folders = F.filter(F.split(path, "/"), lambda x: x != "")
    tail = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3)
    query = F.filter(F.split(F.regexp_extract(tail, r"(?s)^\?([^#]*)", 1), "&"), lambda x: x != "")
    parts = [
        F.transform(F.slice(labels, -1, 1), lambda x: F.concat(F.lit("end:"), x)),
        F.when(n > 1, F.array(F.concat(F.lit("domain:"), F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), "."))))
        .otherwise(F.array().cast("array<string>")),
        F.transform(folders, lambda x, i: F.concat(F.lit("folder"), i.cast("string"), F.lit(":"), x)),
        F.when(n > 2, F.transform(F.slice(labels, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.concat(F.lit("name:"), x)))
        .otherwise(F.array().cast("array<string>")),
        F.when(path.rlike(r"\.[A-Za-z0-9]{1,5}$"), F.array(F.concat(F.lit("file:"), F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)))))
        .otherwise(F.array().cast("array<string>")),
        F.transform(query, lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))),
        F.when(tail.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    ]
    return F.array_distinct(F.concat(*parts))


def mine(known: DataFrame, rows: int = ROWS, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(verdict, tokens, confidence, support) of the rules mined from (page_id, tokens, label)."""
    label = F.concat(F.lit("="), F.col("label"))
    known = known.select("page_id", F.array_distinct("tokens").alias("tokens"), "label")
    n = known.count()
    # a token's pages are told by two sums of hashes of their ids
    number = F.monotonically_increasing_id()
    pages = staged(known.withColumn("__page", number), "marked")
    each = pages.select("__page", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("__page").cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64("__page", F.lit(1)).cast("decimal(38,0)")).alias("b"),
    )
    frequent = each.filter(F.col("n") >= support * n).groupBy("n", "a", "b").agg(F.min("token").alias("token")).select("token")
    sample = hashed_sample(pages.select("page_id", "tokens", "label", "__page"), rows, "page_id", "tokens", "label")
    kept = sample.select("__page", F.explode("tokens").alias("token")).join(frequent, "token")
    kept = kept.groupBy("__page").agg(F.sort_array(F.collect_set("token")).alias("kept"))
    items = sample.join(kept, "__page", "left").select(F.concat(F.coalesce("kept", F.array().cast("array<string>")), F.array(label)).alias("items"))
    items = staged(items, "items")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    mined = model.associationRules
    verdict = mined["consequent"][0]
    own = mined.filter(verdict.startswith("=") & ~F.exists("antecedent", lambda x: x.startswith("=")))
    return own.select(F.substr(verdict, F.lit(2)).alias("verdict"), F.array_sort("antecedent").alias("tokens"), "confidence", "support")


def judged(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): the verdict of the best rule for each distinct set of tokens that any rule fits."""
    rarity = rules.select(F.explode("tokens").alias("token"), "support").groupBy("token").agg(F.max("support").alias("s"))
    filed = rules.withColumn("rule", F.monotonically_increasing_id()) if "rule" not in rules.columns else rules
    first = filed.select("rule", F.explode("tokens").alias("token")).join(rarity, "token")
    first = first.groupBy("rule").agg(F.min_by("token", F.struct("s", "token")).alias("token"))
    index = filed.join(first, "rule").select("token", F.col("tokens").alias("needed"), "verdict", "confidence", "support")
    index = F.broadcast(index) if filed.limit(SENT_RULES + 1).count() <= SENT_RULES else index
    looked = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    held = looked.filter(F.forall("needed", lambda t: F.array_contains(F.col("tokens"), t)))
    best = F.max_by("verdict", F.struct("confidence", "support", F.size("needed"), F.concat_ws(" ", "needed"), "verdict"))
    return held.groupBy("tokens").agg(best.alias("mined"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the mined verdict of every page."""
    named = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    named = named.select(
        "page_id", "host", "path", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
        fitting(F.col("host"), F.col("path"), rules).alias("fixed"),
    )
    marks = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = named.join(marks.withColumnRenamed("doc_id", "page_id"), "page_id", "left")
    label = F.coalesce("fixed.verdict", F.when(F.col("quality") == 0, F.lit("block")).when(F.col("quality") == 1, F.lit("allow")))
    known = marked.select("page_id", "tokens", label.alias("label")).filter("label IS NOT NULL")
    mined = staged(mine(known).withColumn("rule", F.monotonically_increasing_id()), "rules")
    # tokens that no rule has part no sets
    # each is in a share of SUPPORT of the sample, so there are at most as many as tokens of a URL over SUPPORT
    words = sorted(r.t for r in mined.select(F.explode("tokens").alias("t")).distinct().collect())
    known_words = F.lit(words) if words else F.array().cast("array<string>")
    named = named.withColumn("tokens", F.array_sort(F.array_intersect("tokens", known_words)))
    sets = judged(named.select("tokens").distinct(), mined)
    sets = sets.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = named.withColumn("__salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    out = named.join(sets, ["tokens", "__salt"], "left")
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", "mined", F.lit("allow")).alias("verdict"), "mined",
    )


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
