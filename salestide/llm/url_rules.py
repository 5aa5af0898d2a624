"""URL verdicts: stated rules first, then association rules that FP-growth mines from labelled URLs.

A URL is a set of tokens (its site, the parts of its subdomain, its path's segments, its query's keys, numbers masked).
Tokens that always stand together, as those of a template do, are mined as one: combinations of them would be the
same rule over and over, two to the power of their number. Where the labels are those of stated rules, the tokens that
such a rule spells are not evidence for it, and are not learnt from. Spark's FP-growth finds token combinations that are
frequent together with a label; those of enough support and confidence become rules. A rule is indexed under its rarest token, so a URL is compared only with rules that
are indexed under one of its own tokens. URLs with equal token sets are judged once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.session import fits_broadcast, materialize

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
MAX_BROADCAST_RULES = 100_000
# Label tokens cannot clash with those of URLs, which all have a kind and a colon.
_LABELS = ("block", "allow")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class StatedRule:
    """A verdict for a host with all its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules of the query, as its contract states them.
STATED = (
    StatedRule("net", "/", "block"),
    StatedRule("example.net", "/en/", "allow"),
    StatedRule("example.com", "/de/", "block"),
    StatedRule("org", "/fr/", "allow"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Lower-case (A-Z) host with its port; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL, sorted; numbers are masked, so pages of a site share most of them."""
    masked = F.regexp_replace(host(url), "[0-9]+", "0")
    labels = F.filter(F.split(masked, r"\."), lambda x: x != "")
    below = F.array_join(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0))), ".")
    parts = F.filter(F.split(below, r"[.\-_:]"), lambda x: x != "")
    segments = F.filter(F.split(F.regexp_replace(path(url), "[0-9]+", "0"), "/"), lambda x: x != "")
    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")

    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(f"{kind}:"), x))

    last = F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))
    site = F.when(F.size(labels) > 0, F.array(F.concat(F.lit("site:"), F.array_join(last, ".")))).otherwise(F.array())
    every = F.concat(site.cast("array<string>"), named("part", parts), named("path", segments), named("key", keys))
    return F.array_sort(F.array_distinct(every))


def stated_rule(host_: Column, path_: Column, rules: Sequence[StatedRule] = STATED) -> Column:
    """The longest stated rule that fits, as a struct (size, rule, verdict); null if none does."""
    fits = [
        F.when(
            ((host_ == r.host) | host_.endswith(f".{r.host}")) & path_.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    if not fits:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    # At equal lengths the first in order of the list stands.
    return reduce(lambda a, b: F.when(b.isNotNull() & (a.isNull() | (b["size"] > a["size"])), b).otherwise(a), fits)


def unspelled(tokens_: Column, rules: Sequence[StatedRule]) -> Column:
    """``tokens_`` without those that a stated rule of the list spells: its sites, and its path's segments."""
    spelled = F.lit(False)

    def is_spelled(token: Column) -> Column:
        found = spelled
        for rule in rules:
            last = ".".join(rule.host.split(".")[-2:])
            found = found | (token == f"site:{last}") | (token.startswith("site:") & token.endswith(f".{last}"))
            for segment in filter(None, rule.path.split("/")):
                found = found | (token == f"path:{segment}")
        return found

    return F.filter(tokens_, lambda token: ~is_spelled(token))


def _together(labelled: DataFrame) -> DataFrame:
    """``token, name, members``: tokens that the same labelled URLs (``row``, ``tokens``) have, named by the least of them.

    Sets of rows are told apart by two hashes joined over their numbers, so no token's rows are brought together.
    """
    numbered = labelled.select("row", F.explode(F.array_distinct("tokens")).alias("token"))
    held = numbered.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b")
    )
    classes = held.groupBy("n", "a", "b").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return classes.select(F.explode("members").alias("token"), F.col("members")[0].alias("name"), "members")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Association rules of labelled URLs: ``tokens`` (array), ``verdict``, ``confidence``, ``support``, ``index``.

    ``labelled`` has ``tokens`` and ``verdict`` ("block" or "allow"). Kept are rules that, of
    all labelled URLs, at least ``min_support`` fit together with the verdict, and of which at least
    ``min_confidence`` bear it. A rule has all of the tokens that always stand together, or none; ``index`` is its rarest
    token among the labelled URLs.
    """
    spark = labelled.sparkSession
    layout = "tokens array<string>, verdict string, confidence double, support double, index string"
    if labelled.isEmpty():
        return spark.createDataFrame([], layout)
    # Numbered before tokens are taken apart: a number is a URL's, not a token's.
    stored = materialize(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", "verdict"), "url-labels")
    classes = materialize(_together(stored), "url-token-classes")
    names = classes.filter("token = name").select("name")
    few = F.broadcast(names) if fits_broadcast(names, MAX_BROADCAST_RULES) else names
    merged = (
        stored.select("row", "verdict", F.explode(F.array_distinct("tokens")).alias("name")).join(few, "name", "left_semi")
        .groupBy("row", "verdict").agg(F.collect_list("name").alias("names"))
    )
    # URLs without tokens are baskets too: support is a share of all labelled ones.
    whole = stored.select("row", "verdict").join(merged.select("row", "names"), "row", "left")
    baskets = materialize(whole.select(F.concat(F.coalesce("names", F.array().cast("array<string>")), F.array("verdict")).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    found = model.associationRules.filter(
        F.element_at("consequent", 1).isin(*_LABELS)
        & ~F.arrays_overlap("antecedent", F.array(*map(F.lit, _LABELS)))
    ).select(
        F.array_sort("antecedent").alias("names"), F.element_at("consequent", 1).alias("verdict"), "confidence", "support"
    )
    found = materialize(found, "url-rules")
    members = classes.filter("token = name").select(F.col("name").alias("token"), "members")
    spelled = (
        found.select("names", "verdict", F.explode("names").alias("token")).join(single, "token").join(members, "token")
        .groupBy("names", "verdict").agg(
            F.min(F.struct("freq", "token"))["token"].alias("index"), F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens")
        )
    )
    rules = found.join(spelled, ["names", "verdict"]).select("tokens", "verdict", "confidence", "support", "index")
    return materialize(rules, "url-rule-index")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule of each token set that some rule fits: ``tokens``, ``verdict``, ``confidence``, ``mined``.

    The most confident rule wins, then the longer, then the better supported; if all is equal, allow wins.
    ``token_sets`` has distinct ``tokens``.
    """
    index = rules.select(F.col("tokens").alias("needed"), "verdict", "confidence", "support", "index")
    if fits_broadcast(index, MAX_BROADCAST_RULES):
        index = F.broadcast(index)
    rank = F.struct(
        "confidence", F.size("needed").alias("size"), "support", (F.col("verdict") == "allow").alias("allow"), "needed", "verdict"
    )
    return (
        token_sets.select("tokens", F.explode("tokens").alias("index")).join(index, "index")
        .filter(F.size(F.array_except("needed", "tokens")) == 0)
        .groupBy("tokens").agg(F.max(rank).alias("best"))
        .select("tokens", F.col("best.verdict").alias("mined_verdict"), F.col("best.confidence").alias("confidence"),
                F.array_join("best.needed", " ").alias("mined"))
    )


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[StatedRule] = STATED,
    labelled: DataFrame | None = None, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per page: key, ``host``, ``path``, ``rule``, ``verdict``, ``mined``, ``confidence``.

    The longest stated rule decides. Without one, the best mined rule does, and without that the page is
    allowed. ``labelled`` (url, verdict) are the URLs to learn from; if not given, those that a stated rule
    decides. A null url, or one without ``://``, has an empty host and path and no tokens, so it is allowed.
    Null and repeated keys are rows like others; no rows give no rows; other columns are not read.
    """
    stored = materialize(
        pages.select(
            F.col(key).alias("_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
            F.when(F.instr(F.col(url), "://") > 0, tokens(F.col(url))).otherwise(F.array().cast("array<string>")).alias("tokens"),
        ).withColumn("stated", stated_rule(F.col("host"), F.col("path"), rules)),
        "urls",
    )
    if labelled is None:
        evidence = unspelled(F.col("tokens"), rules).alias("tokens")
        known = stored.filter("stated is not null").select(evidence, F.col("stated.verdict").alias("verdict"))
    else:
        known = labelled.select(tokens(F.col("url")).alias("tokens"), "verdict")
    open_ = stored.filter("stated is null")
    best = match(open_.select("tokens").distinct(), mine(known, min_support, min_confidence))
    # A token set with very many pages is a skewed key of this join, which Spark splits at run time.
    mined = open_.join(best, "tokens", "left").select(
        F.col("_key").alias(key), "host", "path", F.lit(None).cast("string").alias("rule"),
        F.coalesce("mined_verdict", F.lit("allow")).alias("verdict"), "mined", "confidence",
    )
    ruled = stored.filter("stated is not null").select(
        F.col("_key").alias(key), "host", "path", F.col("stated.rule").alias("rule"), F.col("stated.verdict").alias("verdict"),
        F.lit(None).cast("string").alias("mined"), F.lit(None).cast("double").alias("confidence"),
    )
    return ruled.unionByName(mined)
