"""URL filters: rules for hosts and paths, and empirical-Bayes reputations of hosts."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.texts import spread_join
from tillwise.sources import scratch

# Public suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
    "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)


@dataclass(frozen=True)
class Rule:
    """Allows or blocks what lies under a path of a host and of all its subdomains."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null without one. Rules are a short list."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address of digits is its own domain and suffix."""
    labels = F.split(host, r"\.")
    two = F.substring_index(host, ".", -2)
    paired = (F.size(labels) > 2) & two.isin(*TWO_LABEL_SUFFIXES)
    address = host.rlike(r"^[0-9.]+$")
    domain = F.when(address, host).when(paired, F.substring_index(host, ".", -3)).otherwise(two)
    suffix = F.when(address, host).when(paired, two).otherwise(F.substring_index(host, ".", -1))
    return domain, suffix


def _strength(children: DataFrame, parent: list[str]) -> DataFrame:
    """One row with the weight, in pages, of a parent's rate as prior of its children.

    From the spread of the children's rates about their parents' beyond what
    chance gives (the moment estimator of the correlation inside a group), kept
    between 1 and 10,000; without any such spread it is 10,000.
    """
    seen = children.filter("n > 0")
    of = seen.groupBy(*parent) if parent else seen.groupBy(F.lit(0).alias("all"))
    above = of.agg(
        F.sum("n").cast("double").alias("n"), F.sum("k").cast("double").alias("k"), F.count(F.lit(1)).alias("j"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).cast("double").alias("m"),
    )
    sums = above.agg(
        F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("j") - 1).alias("df"),
        F.sum(F.col("q") - F.col("k") * F.col("k") / F.col("n")).alias("s"), F.sum(F.col("m") / F.col("n")).alias("m"),
    )
    noise = F.col("k") / F.col("n") * (1 - F.col("k") / F.col("n"))
    rho = F.try_divide(F.col("s") - noise * F.col("df"), noise * (F.col("n") - F.col("m") - F.col("df")))
    strength = F.when(rho > 0, 1 / rho - 1).otherwise(10000.0)
    return sums.select(F.coalesce(F.greatest(F.lit(1.0), F.least(F.lit(10000.0), strength)), F.lit(10000.0)).alias("strength"))


def reputations(hosts: DataFrame, z: float) -> DataFrame:
    """Posterior of each host's rate of good pages.

    ``hosts`` has host, n (labelled pages) and k (good ones), one row per host;
    n may be 0. The rate of all pages is the prior of suffixes, a suffix's
    shrunken rate that of its registered domains, a domain's that of its hosts:
    Beta(strength * rate, strength * (1 - rate)) at each level, with a strength
    per level from the data. Adds mean, deviation and the lower bound
    mean - z * deviation. Without any labelled page the rate is 1/2.
    """
    domain, suffix = _levels(F.col("host"))
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(0.5)).alias("rate"))

    def shrunk(out: str) -> Column:
        return ((F.col("k") + F.col("strength") * F.col("rate")) / (F.col("n") + F.col("strength"))).alias(out)

    suffixes = suffixes.join(_strength(suffixes, [])).join(total)
    suffixes = suffixes.select("suffix", shrunk("suffix_rate"))
    domains = domains.join(_strength(domains, ["suffix"])).join(suffixes.withColumnRenamed("suffix_rate", "rate"), "suffix")
    domains = domains.select("domain", "suffix", shrunk("rate"))
    judged = hosts.join(_strength(hosts, ["domain", "suffix"])).join(domains, ["domain", "suffix"])
    a, b = F.col("k") + F.col("strength") * F.col("rate"), F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("rate"))
    judged = judged.withColumn("mean", a / (a + b)).withColumn("deviation", F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return judged.select("host", "n", "k", "mean", "deviation", (F.col("mean") - z * F.col("deviation")).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], least_good: float = 0.5, z: float = 1.645) -> DataFrame:
    """Allow or block every page by its url.

    ``pages`` has page_id and url, ``outcomes`` page_id and good (boolean) of the
    labelled pages. The longest rule that fits decides; else a page is allowed if
    the lower posterior bound of its host's rate of good pages is at least
    ``least_good``. Returns page_id, host, path, rule, verdict, bound.

    A null url, or one without ``://``, has an empty host and path; the empty host
    is judged like any other. A page with several outcomes is good if all are;
    null outcomes and outcomes of unknown or null pages say nothing. Repeated page
    rows stay, and count as often as they stand. Other columns are left out.
    """
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    read = scratch.stage(read, "urls")
    known = outcomes.filter("good is not null").groupBy("page_id").agg(F.min(F.col("good").cast("int")).alias("good"))
    hosts = read.join(known, "page_id", "left").groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"), F.count(F.lit(1)).alias("rows")
    )
    hosts = scratch.stage(hosts, "hosts")
    judged = reputations(hosts.drop("rows"), z).select("host", "bound").join(hosts.select("host", "rows"), "host")
    rule, decided = longest_rule(rules, F.col("host"), F.col("path"))
    by_host = F.when(F.col("bound") >= least_good, "allow").otherwise("block")
    return spread_join(read, judged, "host", "rows", read.count()).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, by_host).alias("verdict"), "bound"
    )
