"""URL filter: explicit rules first, then an empirical-Bayes reputation of the host.

Labelled outcomes of pages are counted per host, registered domain and suffix.
Each level's rate is shrunk towards its parent's through a beta-binomial prior
whose strength comes from the spread of the groups at that level (method of
moments). A host passes if the lower bound of its posterior passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.common import sized_broadcast
from stayline.session import staged


class Rule(NamedTuple):
    action: str
    host: str
    path: str


#: The production rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
# Common suffixes of two labels.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp",
    "com.br", "com.cn", "com.tw", "com.mx", "com.tr", "co.in", "co.kr", "co.za",
)
#: Posterior mean minus this many standard deviations must reach the least rate.
DEVIATIONS = 1.645
LEAST_RATE = 0.5
#: Bounds of the prior's strength in pseudo-counts.
STRENGTH = (1.0, 1000.0)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (host and path as text) that fits, as a struct (text, action); null if none does."""
    choices = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(r.host + r.path).alias("text"), F.lit(r.action).alias("action")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    ]
    nothing = F.lit(None).cast("struct<text: string, action: string>")
    return F.coalesce(*choices, nothing) if choices else nothing


def _names(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; user and port are left out."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    two, one = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -1)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(one)
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(groups: DataFrame) -> float:
    """Pseudo-counts of the prior of groups (n, good, parent), from their spread around the parents.

    With rho = 1 / (strength + 1), n (p - m)^2 / (m (1 - m)) has the expectation
    1 + (n - 1) rho. Without a group of two or more the prior is at its strongest.
    """
    m = F.col("parent")
    excess = F.col("n") * F.pow(F.col("good") / F.col("n") - m, 2) / (m * (1 - m)) - 1
    row = groups.where(F.col("n") > 0).agg(F.sum(excess).alias("a"), F.sum(F.col("n") - 1).alias("b")).first()
    weakest, strongest = STRENGTH
    rho = row["a"] / row["b"] if row["b"] else 0.0
    return strongest if rho <= 0 else min(strongest, max(weakest, 1 / rho - 1))


def _shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
    """Groups with ``mean``, their rate shrunk towards ``parent``, and the strength used."""
    strength = _strength(groups)
    return groups.withColumn("mean", (F.col("good") + strength * F.col("parent")) / (F.col("n") + strength)), strength


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per host of ``pages``: host, mean and bound of its rate of good pages.

    ``outcomes`` is (page_id, good) with good 0 or 1; null outcomes are left out,
    several outcomes of a page all count. A host without outcomes has its
    domain's rate, a domain without any its suffix's, and so on up to the overall
    rate (good + 1) / (n + 2).
    """
    hosts = pages.select(F.col("page_id").alias("_page"), host_of(F.col("url")).alias("host"))
    labelled = outcomes.where(F.col("good").isNotNull()).select(
        F.col("page_id").alias("_page"), F.col("good").cast("long").alias("good")
    )
    seen = hosts.join(labelled, "_page").groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    domain, suffix = _names(F.col("host"))
    by_host = staged(
        hosts.groupBy("host").agg(F.lit(0).alias("zero")).join(seen, "host", "left").select(
            "host", domain.alias("domain"), suffix.alias("suffix"),
            F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("good", F.lit(0)).alias("good"),
        ),
        "hosts",
    )
    count = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = by_host.agg(*count).first()
    overall = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)
    suffixes, _ = _shrunk(staged(by_host.groupBy("suffix").agg(*count), "suffixes").withColumn("parent", F.lit(overall)))
    above = suffixes.select("suffix", F.col("mean").alias("parent"))
    domains, _ = _shrunk(
        staged(by_host.groupBy("domain", "suffix").agg(*count).join(above, "suffix"), "domains")
    )
    above = domains.select("domain", "suffix", F.col("mean").alias("parent"))
    placed, strength = _shrunk(staged(by_host.join(above, ["domain", "suffix"]), "placed"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strength + 1))
    return placed.select("host", "mean", (F.col("mean") - DEVIATIONS * spread).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    The longest rule that fits decides; else the host is allowed if its posterior
    bound is at least :data:`LEAST_RATE`. Null urls and urls without ``://`` have
    an empty host and path, and are judged as pages of the host "". Repeated rows
    are judged each; only ``page_id`` and ``url`` are read.
    """
    known = staged(reputations(pages, outcomes), "reputations")
    sized = sized_broadcast(known, F.length("host") * 4 + 48)
    judged = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    # One host may hold a third of all pages: beyond a broadcast, adaptive execution splits its partition.
    by_host = F.when(F.col("bound") >= LEAST_RATE, "allow").otherwise("block")
    return judged.join(sized, "host", "left").select(
        "page_id", "host", "path", F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.action"), by_host).alias("verdict"),
    )
