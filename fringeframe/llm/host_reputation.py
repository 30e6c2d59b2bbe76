"""Host reputation by empirical Bayes, in DataFrame expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Second-level labels that, under a two-letter top level, belong to the public suffix (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or where ``://`` is missing."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    before = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.translate(F.regexp_extract(before, r"(?s)^([^/]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(before, r"(?s)^[^/]*(.*)$", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Public suffix (one label, or two such as co.uk) and registered domain (one label more, if there is one)."""
    label = F.split(host, r"\.")
    two = (F.size(label) >= 3) & (F.length(F.element_at(label, -1)) == 2) & F.try_element_at(label, F.lit(-2)).isin(*SECOND_LEVEL)
    suffix = F.when(two, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    return suffix, F.when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _strength(groups: DataFrame, mean: float, least: float, most: float) -> float:
    """Prior strength of a beta-binomial by moments of the groups' rates, between ``least`` and ``most``."""
    seen = groups.where("n > 0")
    r = seen.agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, F.lit(2))).alias("s")).first()
    if not r["g"] or r["g"] < 2 or mean <= 0 or mean >= 1:
        return most
    noise = mean * (1 - mean)
    room = noise * (r["n"] - r["nn"] / r["n"] - (r["g"] - 1))
    spread = (r["s"] - noise * (r["g"] - 1)) / room if room > 0 else 0.0
    return max(least, min(most, 1 / spread - 1)) if spread > 0 else most


def judge_hosts(pages: DataFrame, outcomes: DataFrame, rules: tuple[UrlRule, ...] = (), z: float = 1.645, worst_rate: float = 0.5, least: float = 1.0, most: float = 1000.0) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and the evidence to every page.

    ``pages`` has ``page_id`` and ``url``; ``outcomes`` has ``page_id`` and ``good`` (0 or 1; null is none).
    Good rates shrink from the whole to suffix, registered domain and host, each level's prior strength
    being estimated by moments within [``least``, ``most``].  A host is blocked if even the upper bound
    ``mean + z * sd`` of its posterior is under ``worst_rate``; an unseen host keeps its domain's rate.
    The longest fitting rule decides instead (of equal lengths, block).  Null and malformed urls share the
    empty host.  Several outcomes of one page all count; repeated pages count once each; without outcomes
    the rate is 0.5; an empty table gives an empty result.  Columns named like a result are replaced.
    Counts are summed before they are shuffled; a page joins its host by an equi-join that adaptive
    execution splits where a host is hot.
    """
    added = ["host", "path", "rule", "verdict", "host_good", "host_labelled", "host_rate", "host_upper"]
    pages = pages.drop(*added)
    host, path = url_parts(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path})
    votes = outcomes.where(F.col("good").isNotNull() & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.sum(F.col("good").cast("long")).alias("good"), F.count("good").alias("n"))
    hosts = pages.select("page_id", "host").join(votes, "page_id", "left").groupBy("host").agg(F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    suffix, domain = suffix_and_domain(F.col("host"))
    # Written once: everything up to the verdicts is worked out from this one count of the pages.
    hosts = written(hosts.withColumns({"suffix": suffix, "domain": domain}))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = suffixes.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = ((whole["good"] or 0) + 1) / ((whole["n"] or 0) + 2)
    strengths = [_strength(x, mean, least, most) for x in (suffixes, domains, hosts)]

    def rate(parent: Column | float, k: float) -> Column:
        return (F.col("good") + F.lit(float(k)) * parent) / (F.col("n") + F.lit(float(k)))

    suffixes = suffixes.select("suffix", rate(F.lit(mean), strengths[0]).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("domain", rate(F.col("suffix_rate"), strengths[1]).alias("domain_rate"))
    m = F.col("host_rate")
    hosts = hosts.join(domains, "domain").select("host", F.col("good").alias("host_good"), F.col("n").alias("host_labelled"), rate(F.col("domain_rate"), strengths[2]).alias("host_rate"))
    hosts = hosts.withColumn("host_upper", m + F.lit(float(z)) * F.sqrt(m * (1 - m) / (F.col("host_labelled") + F.lit(strengths[2] + 1))))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("host_upper") < worst_rate, "block").otherwise("allow")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return pages.join(hosts, "host", "left").withColumns({"rule": rule, "verdict": verdict}).select(*[c for c in pages.columns if c not in added], *added)
