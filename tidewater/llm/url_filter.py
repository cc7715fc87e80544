"""URL verdicts: allow and block rules, and gradient-boosted trees on lexical features for the rest.

The rules label the URLs they fit; the trees learn from these and judge all others.
Features: length, path depth, digit ratio, entropy of the characters, numbers of
parameters, hyphens and host labels, and how often the host's suffix occurs and is
blocked among all labelled rows.  The fit uses at most MOST_LABELLED labelled rows
of each verdict, those with the smallest hash; suffix statistics use all rows.

The host is what follows the first `://`, up to `/`, `?`, `#` or the end, with A-Z
lowered; the path follows up to `?`, `#` or the end.  A null URL or one without
`://` has neither, fits no rule and is judged by the trees on empty features.  If
only one verdict is labelled there is nothing to learn: all others are allowed,
or blocked when only block is labelled.  Repeated rows count each; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import staged

MOST_LABELLED = 20_000
TREES, DEPTH = 12, 3
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~/:?#@!&+,;=%"
FEATURES = ("length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "labels", "host_length", "suffix_count", "suffix_blocked")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; rules are (`allow` or `block`, host and path in one)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the longest comes last and wins
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _occurrences(text: Column, what: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(what)))


def _entropy(text: Column) -> Column:
    """Bits per character; characters outside the alphabet count as one."""
    n = F.char_length(text)
    counts = F.array(*[_occurrences(text, c) for c in ALPHABET])
    total = F.aggregate(counts, F.lit(0), lambda a, c: a + c)
    known = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0))
    other = n - total
    return F.when(n > 0, F.log2(n.cast("double")) - (known + F.when(other > 0, other * F.log2(other.cast("double"))).otherwise(0.0)) / n).otherwise(0.0)


def with_features(urls: DataFrame) -> DataFrame:
    """Add the lexical features to rows with `url, host, path`."""
    url = F.lower(F.coalesce("url", F.lit("")))
    n = F.greatest(F.char_length(url), F.lit(1))
    digits = n - F.char_length(F.regexp_replace(url, "[0-9]", "")) - F.when(url == "", 1).otherwise(0)
    return urls.withColumns(
        {
            "length": F.log1p(F.char_length(url).cast("double")),
            "depth": _occurrences(F.col("path"), "/").cast("double"),
            "digit_ratio": digits / n,
            "entropy": _entropy(url),
            "parameters": (_occurrences(url, "&") + _occurrences(url, "?")).cast("double"),
            "hyphens": _occurrences(F.col("host"), "-").cast("double"),
            "labels": _occurrences(F.col("host"), ".").cast("double"),
            "host_length": F.char_length("host").cast("double"),
            "suffix": F.substring_index("host", ".", -2),
        }
    )


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """`suffix, suffix_count, suffix_blocked` over all rows: log count, smoothed share of blocks among labelled rows."""
    counted = urls.groupBy(F.col("suffix").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("known"), F.count_if(F.col("label") == "block").alias("blocked"))
    return counted.select(F.col("of"), F.log1p(F.col("n").cast("double")).alias("suffix_count"), ((F.col("blocked") + 1) / (F.col("known") + 2)).alias("suffix_blocked"))


def labelled_sample(urls: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of each label, by the smallest hash of the URL."""
    key = F.xxhash64("url", "key")
    parts = [urls.where(F.col("label") == v).orderBy(key).limit(most) for v in ("allow", "block")]
    return parts[0].unionByName(parts[1]).select((F.col("label") == "block").cast("double").alias("target"), *FEATURES)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url", most: int = MOST_LABELLED, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """`page_id, host, path, rule, verdict, blocked_by_trees` of every row."""
    urls = pages.select(F.col(page_id).alias("key"), F.col(url).alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, label = matched_rule(F.col("host"), F.col("path"), rules)
    plain = staged(with_features(urls.withColumns({"rule": rule, "label": label})), "urls")
    stats = suffix_statistics(plain)
    ready = plain.join(stats, plain["suffix"] == stats["of"])
    train = staged(labelled_sample(ready, most), "labelled")
    seen = {r["target"] for r in train.select("target").distinct().collect()}
    if len(seen) == 2:
        to_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        model = GBTClassifier(labelCol="target", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1).fit(to_vector.transform(train.coalesce(2)))
        scored = model.transform(to_vector.transform(ready)).withColumn("blocks", F.col("prediction") == 1.0)
    else:
        scored = ready.withColumn("blocks", F.lit(seen == {1.0}))
    verdict = F.coalesce("label", F.when(F.col("blocks"), F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(F.col("key").alias("page_id"), "host", "path", "rule", verdict.alias("verdict"), F.col("blocks").alias("blocked_by_trees"))
