"""URL filters: explicit host and path rules, and gradient-boosted trees for all other URLs.

The trees see lexical features only: lengths, depth, digit ratio, entropy, counts of parameters and
separators, and block statistics of the host's suffix, all computed by Spark expressions. They are
trained by Spark ML from labelled URLs. What a suffix's block rate says of a labelled URL is taken from
URLs of other domains, never from its own label; else the trees would learn to read the labels off it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace

BLOCK, ALLOW = "block", "allow"

# Suffix statistics are kept by hash bucket and fold, so their table has at most this many rows for
# each fold. Suffixes of one bucket share their statistics.
SUFFIX_BUCKETS = 4096
# A labelled URL's statistics come from the other folds; all URLs of a domain are in one.
FOLDS = 5
# Weight of the overall block rate in a suffix's rate, in URLs.
PRIOR_URLS = 10.0
# Labelled URLs the trees are fitted on at most; a hash of the URL chooses them beyond that.
MAX_LABELLED = 1_000_000

LEXICAL = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "digit_ratio",
    "entropy",
    "params",
    "host_labels",
    "hyphens",
    "secure",
    "fragment",
)
SUFFIX = ("suffix_rate", "suffix_urls")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty
    for null and where there is no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Position in ``rules`` of the longest rule that fits, null if none does; of equally long ones
    the first."""
    found = F.lit(None).cast("int")
    order = sorted(range(len(rules)), key=lambda n: (-len(rules[n].text), n))
    for n in reversed(order):
        rule = rules[n]
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(n)).otherwise(found)
    return found


def _pick(position: Column, values: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for n, value in enumerate(values):
        out = F.when(position == n, F.lit(value)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters in bits."""
    size = F.length(text)
    counts = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: size - F.length(F.replace(text, c, F.lit("")))
    )
    bits = F.aggregate(
        counts,
        F.lit(0.0),
        lambda total, n: total - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0),
    )
    return F.when(size > 0, bits).otherwise(0.0)


def with_features(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    text = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    size = F.length(text)
    values = {
        "url_length": size,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda part: part != "")),
        "digit_ratio": F.when(size > 0, digits / size).otherwise(0.0),
        "entropy": entropy(text),
        "params": F.size(F.filter(F.split(query, "&"), lambda part: part != "")),
        "host_labels": F.size(F.split(host, r"\.")),
        "hyphens": size - F.length(F.replace(text, F.lit("-"), F.lit(""))),
        "secure": text.startswith("https://").cast("int"),
        "fragment": text.contains("#").cast("int"),
    }
    suffix = F.substring_index(host, ".", -1)
    bucket = F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_BUCKETS)).cast("int")
    fold = F.pmod(F.xxhash64(F.substring_index(host, ".", -2)), F.lit(FOLDS)).cast("int")
    columns = {**{k: v.cast("double") for k, v in values.items()}, "bucket": bucket, "fold": fold}
    return df.withColumns(columns)


@dataclass(frozen=True)
class UrlModel:
    trees: GBTClassificationModel | None
    suffixes: DataFrame
    rate: float


def suffix_statistics(labelled: DataFrame, rate: float) -> DataFrame:
    """Block rate and number of labelled URLs by bucket, for each fold without the URLs of that fold,
    and for fold -1 with all of them."""
    counted = labelled.groupBy("bucket", "fold").agg(
        F.count(F.lit(1)).alias("urls"), F.count_if("blocked").alias("blocked")
    )
    whole = Window.partitionBy("bucket")
    every = {c: F.sum(c).over(whole) for c in ("urls", "blocked")}
    others = counted.select(
        "bucket", "fold", *((every[c] - F.col(c)).alias(c) for c in ("urls", "blocked"))
    )
    total = counted.groupBy("bucket", F.lit(-1).alias("fold")).agg(
        F.sum("urls").alias("urls"), F.sum("blocked").alias("blocked")
    )
    blocked = F.col("blocked") + F.lit(PRIOR_URLS * rate)
    return others.unionByName(total).select(
        "bucket",
        "fold",
        (blocked / (F.col("urls") + F.lit(PRIOR_URLS))).alias("suffix_rate"),
        F.log1p("urls").alias("suffix_urls"),
    )


def _with_suffixes(df: DataFrame, suffixes: DataFrame, rate: float) -> DataFrame:
    # At most SUFFIX_BUCKETS * (FOLDS + 1) rows.
    joined = df.join(F.broadcast(suffixes), ["bucket", "fold"], "left")
    return joined.fillna({"suffix_rate": rate, "suffix_urls": 0.0})


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(df)


def train(
    labelled: DataFrame, work: Workspace, max_iter: int = 20, max_depth: int = 4
) -> UrlModel:
    """Fit the trees on ``labelled``, which has the features of ``with_features``, a column ``url``
    and a boolean ``blocked``. Without any labelled URL nothing is learnt and nothing blocked.

    The bounded sample is written once, as every level of every tree reads it."""
    totals = labelled.agg(
        F.count(F.lit(1)).alias("urls"), F.count_if("blocked").alias("blocked")
    ).first()
    rate = totals["blocked"] / totals["urls"] if totals["urls"] else 0.0
    suffixes = suffix_statistics(labelled, rate)
    if not totals["urls"]:
        return UrlModel(None, suffixes, rate)
    share = min(1.0, MAX_LABELLED / totals["urls"])
    place = F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < F.lit(share * (1 << 20))
    rows = _with_suffixes(labelled.where(place), suffixes, rate)
    rows = _assembled(rows).select("features", F.col("blocked").cast("double").alias("label"))
    rows = work.keep(rows, "labelled-urls")
    trees = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=7, cacheNodeIds=False)
    return UrlModel(trees.fit(rows), suffixes, rate)


def block_probability(df: DataFrame, model: UrlModel) -> DataFrame:
    """``df``, with the features of ``with_features``, plus ``block_probability``."""
    if model.trees is None:
        return df.withColumn("block_probability", F.lit(0.0))
    rows = _with_suffixes(df.withColumn("fold", F.lit(-1)), model.suffixes, model.rate)
    rows = _assembled(rows)
    scored = model.trees.transform(rows)
    return scored.withColumn("block_probability", vector_to_array("probability")[1])


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    work: Workspace,
    url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``pages`` with host, path, rule, block_probability and verdict of every URL.

    A rule that fits decides; the longest one does. Otherwise the trees decide, trained on the URLs
    that rules do decide. Defined cases: a null URL, or one without ``://``, has empty host and path,
    and trees judge it by its features like any other; repeated rows are judged alike; an empty table
    gives an empty result; columns of ``pages`` that have one of the five names are replaced.
    """
    added = ("host", "path", "rule", "block_probability", "verdict")
    base = pages.select(
        F.struct(*(c for c in pages.columns if c not in added)).alias("page"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    base = base.withColumn("fits", longest_rule(F.col("host"), F.col("path"), rules))
    featured = with_features(base, "url", "host", "path")
    ruling = _pick(F.col("fits"), [r.verdict for r in rules])
    labelled = featured.where(F.col("fits").isNotNull()).withColumn("blocked", ruling == BLOCK)
    model = train(labelled.drop("page"), work)
    judged = F.when(F.col("block_probability") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return block_probability(featured, model).select(
        "page.*",
        "host",
        "path",
        _pick(F.col("fits"), [r.text for r in rules]).alias("rule"),
        "block_probability",
        F.coalesce(ruling, judged).alias("verdict"),
    )
