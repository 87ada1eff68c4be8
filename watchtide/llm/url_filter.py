"""URL verdicts: listed rules first, then the reputation of the host, shrunk towards its domain and suffix.

Labelled pages give every host a count of pages and of bad ones. A host's share of bad pages is beta-binomial with a
prior around the share of its registered domain, which has one around its suffix, which has one around all pages. The
strength of the priors of a level is fitted to how much its shares differ beyond chance. A host is blocked when even
the lower bound of its posterior share is beyond the limit, so a few bad pages of a small host do not suffice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from watchtide.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Second-level labels under which countries register names.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains for paths that start with ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Reputation:
    """Share of bad pages that blocks a host, deviations below the posterior mean, and bounds of the priors' strength."""

    limit: float = 0.2
    deviations: float = 2.0
    weakest: float = 2.0
    strongest: float = 1000.0


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The fitting rule with the longest text, as a struct of ``rule`` and ``verdict``; null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host, r.path))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _parents(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; a one-label host is both itself."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    two = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n > 1, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    width = F.when(two, 2).otherwise(1)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.least(k, n)), ".")
    return last(width + 1), last(width)


def _strength(level: DataFrame, rule: Reputation) -> float:
    """How many pages the prior of a level weighs, from the spread of its shares beyond binomial chance."""
    one = level.filter("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("bb")
    ).first()
    most = rule.strongest
    if one.k < 2 or not 0 < one.bad < one.n:
        return most
    mean = one.bad / one.n
    spread = (one.bb - mean * one.bad) / (mean * (1 - mean)) - (one.k - 1)
    room = one.n - one.nn / one.n - (one.k - 1)
    alike = spread / room if room > 0 else 0.0
    return most if alike <= 1 / (1 + most) else max(rule.weakest, (1 - alike) / alike)


def host_reputation(pages: DataFrame, outcomes: DataFrame, rule: Reputation = Reputation()) -> DataFrame:
    """One row per host of ``pages (page_id, host)``: ``n`` labelled pages, ``bad`` ones, posterior ``mean`` and ``low``.

    ``outcomes (page_id, bad)`` has 0 or 1 a row; a page with several is bad if one is. Pages and hosts without an
    outcome count 0 pages and get the mean of their domain. Without any outcome all means are 1/2. Counts are made per
    host before they meet; one host may have any share of the pages.
    """
    judged = outcomes.filter("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = pages.join(judged, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("bad"))
    domain, suffix = _parents(F.col("host"))
    hosts = stored(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    everything = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    of_all = (everything.bad + 0.5) / (everything.n + 1.0)
    by_suffix, by_domain, by_host = (_strength(x, rule) for x in (suffixes, domains, hosts))

    def shrunk(bad: Column, n: Column, prior: Column, strength: float) -> Column:
        return (bad + prior * strength) / (n + strength)

    # A parent's share is taken without the pages of the child, which would otherwise count twice.
    above = suffixes.select("suffix", F.col("n").alias("suffix_n"), F.col("bad").alias("suffix_bad"))
    rest = F.col("suffix_bad") - F.col("bad"), F.col("suffix_n") - F.col("n")
    domains = domains.join(above, "suffix").select(
        "domain", "suffix", F.col("n").alias("domain_n"), F.col("bad").alias("domain_bad"), shrunk(*rest, F.lit(of_all), by_suffix).alias("suffix_mean")
    )
    rest = F.col("domain_bad") - F.col("bad"), F.col("domain_n") - F.col("n")
    prior = shrunk(*rest, F.col("suffix_mean"), by_domain)
    means = hosts.join(domains, ["domain", "suffix"]).select("host", "n", "bad", shrunk(F.col("bad"), F.col("n"), prior, by_host).alias("mean"))
    low = F.col("mean") - rule.deviations * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + by_host + 1))
    return means.withColumn("low", low)


def url_verdicts(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...], rule: Reputation = Reputation(), id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: ``id``, ``host``, ``path``, ``rule``, ``verdict``, then the host's ``n``, ``bad``, ``mean``, ``low``.

    The longest fitting rule decides; where none fits, ``block`` if ``low`` is over the limit, else ``allow``. A null
    url, or one without ``://``, has an empty host and path, which no rule fits and which is judged like any host.
    Repeated rows are each judged. Null ids have no outcome. An empty table gives no rows; other columns are not read.
    """
    spread = pages.select(pages[id].alias("page_id"), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
    known = stored(host_reputation(spread.select("page_id", "host"), outcomes, rule), "reputation")
    found = spread.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules)).join(known, "host")
    own = F.when(F.col("low") > rule.limit, "block").otherwise("allow")
    return found.select(F.col("page_id").alias(id), "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"), "n", "bad", "mean", "low")
