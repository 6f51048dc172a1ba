"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Labelled pages are good or bad. A beta prior for suffixes is fitted to all outcomes by moments; each
suffix's posterior mean is the centre of the prior of its registered domains, and each domain's of
its hosts. How strongly a level holds to the one above is fitted by moments too. A page is allowed
when the lower bound of its host's posterior share of good pages reaches ``cutoff``. A host without
outcomes stands on its domain, a domain on its suffix.

All is counting by host, then by domain, then by suffix, each from the level below, with map-side
aggregation; pages meet their host's row in a join that Spark splits for a hot host.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import lower_ascii
from shelfline.session import stage_table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: The posterior share of good pages must reach this with one-sided confidence of 95 %.
CUTOFF, Z = 0.5, 1.645
#: Bounds of a fitted prior strength, in pages.
WEAKEST, STRONGEST = 2.0, 200.0


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lowered; empty without :// or url."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits as struct (rule, verdict), or null. Rules are a short list in code; ties go to the first name."""
    result = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        result = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(result)
    return result


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(level: DataFrame) -> float:
    """The beta prior strength of a level by moments; its prior means are in ``above``.

    With outcomes y of n and prior mean m, E[(y - n m)^2] = n m (1 - m) (1 + (n - 1) r), where
    r = 1 / (strength + 1). Sums over all groups of the level give r.
    """
    m, n, y = F.col("above"), F.col("n").cast("double"), F.col("good").cast("double")
    row = level.where("n > 0").agg(F.sum((y - n * m) * (y - n * m) - n * m * (1 - m)), F.sum(n * (n - 1) * m * (1 - m))).first()
    extra, base = row[0] or 0.0, row[1] or 0.0
    if extra <= 0 or base <= 0:
        return STRONGEST
    return max(WEAKEST, min(STRONGEST, base / extra - 1))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, good, mean, lower) for every host of ``pages`` (page_id, url).

    ``outcomes`` has (page_id, good 0/1), at most one row counts for a page: several are averaged to
    good only when all are. Without any outcome all means are one half.
    """
    judged = outcomes.where("page_id IS NOT NULL AND good IS NOT NULL").groupBy("page_id").agg(F.min("good").alias("good"))
    seen = pages.select("page_id", host_of(F.col("url")).alias("host")).join(judged, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"))
    hosts = stage_table(hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "good"), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    good, n = suffixes.agg(F.sum("good"), F.sum("n")).first()
    suffixes = _shrunk(suffixes.withColumn("above", F.lit(((good or 0) + 1) / ((n or 0) + 2))), "suffix_mean")
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("suffix_mean").alias("above")), "suffix"), "domain_mean")
    known = hosts.join(domains.select("domain", F.col("domain_mean").alias("above")), "domain")
    strength = _strength(known)
    a, b = F.col("above") * strength + F.col("good"), (1 - F.col("above")) * strength + F.col("n") - F.col("good")
    mean, spread = a / (a + b), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return known.select("host", "domain", "suffix", "n", "good", mean.alias("mean"), (mean - Z * spread).alias("lower"))


def _shrunk(level: DataFrame, name: str) -> DataFrame:
    """Posterior mean of each group of a level whose prior mean is in ``above``."""
    strength = _strength(level)
    return level.withColumn(name, (F.col("above") * strength + F.col("good")) / (strength + F.col("n"))).drop("above")


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, cutoff: float = CUTOFF) -> DataFrame:
    """(page_id, host, path, rule, verdict, lower) for every row of ``pages``.

    A rule's verdict comes first. Else the host's posterior decides; pages without a host share the
    reputation of the empty host. Repeated rows are judged alike; other columns are not read.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = split.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    joined = ruled.join(host_reputation(pages, outcomes).select("host", "lower"), "host", "left")
    verdict = F.coalesce("hit.verdict", F.when(F.col("lower") >= cutoff, "allow").otherwise("block"))
    return joined.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), "lower")
