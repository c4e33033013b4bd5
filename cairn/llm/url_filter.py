"""URL filter by empirical-Bayes host reputation (native: DataFrame functions only).

A host's share of bad pages is estimated from labelled outcomes. Beta-binomial
priors run down the tree suffix -> registered domain -> host: each level's prior is
centred on its parent's posterior mean, with a strength fitted by moments over all
children of that level. A host is blocked if the lower posterior bound of its bad share
lies above twice the base rate, or above one half; explicit rules override. Where outcomes
do not hang on hosts, shares shrink to the base rate and none is blocked.

Edge cases: a null url or one without "://" has host and path '' and no rule, and is
judged as the host ''. Labels that are null count as unlabelled; repeated pages and
repeated labels count as often as they stand. Without any label every prior is
p = 1/2 and nothing is blocked. Null page ids stay and match no label. Empty tables
give an empty result. Only page_id and url of pages are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .env import staged

#: Second-level labels under which country registries sell names. Fixed values. A suffix is the
#: last label, or two if that has two letters and the one before is of these (co.uk, com.au, or.jp): a rule, not a list of all suffixes.
GENERIC = ("ac", "asn", "co", "com", "edu", "firm", "gen", "go", "gob", "gouv", "gov", "govt", "gv", "id", "info", "lg", "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "sch", "tm", "web")
TWO_LABELS = r"^(" + "|".join(GENERIC) + r")\.[a-z]{2}$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Reputation:
    ratio: float = 2.0  # of the base rate, a bad share that must be exceeded
    most: float = 0.5  # beyond which a share is bad whatever the base rate
    z: float = 1.6448536269514722  # of the one-sided 95 % bound
    default_strength: float = 2.0  # of a prior whose level shows nothing


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(r"^[0-9.]+$"), host).when(two.rlike(TWO_LABELS), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(r"^[0-9.]+$"), host).when(two.rlike(TWO_LABELS), F.substring_index(host, ".", -3)).otherwise(two)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def strength(children: DataFrame, parent: str, default: float) -> float:
    """Prior strength of one level: (1 - r) / r for the moment estimate r of the
    correlation of outcomes within a child, over children (parent, n, k)."""
    one = (
        children.filter("n > 0").groupBy(parent)
        .agg(F.sum("n").alias("n_"), F.sum("k").alias("k_"), F.count("*").alias("j_"), F.sum(F.col("n") * F.col("n")).alias("q_"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("a_"))
        .withColumn("v_", F.col("k_") / F.col("n_") * (1 - F.col("k_") / F.col("n_")))
        .agg(
            F.sum(F.col("a_") - F.col("k_") * F.col("k_") / F.col("n_") - F.col("v_") * (F.col("j_") - 1)).alias("num"),
            F.sum(F.col("v_") * (F.col("n_") - F.col("q_") / F.col("n_") - (F.col("j_") - 1))).alias("den"),
        ).first()
    )
    if one is None or one.den is None or one.den <= 0:
        return default
    r = min(max(one.num / one.den, 1e-4), 0.999)
    return (1 - r) / r


def base_rate(hosts: DataFrame) -> float:
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    return ((total.k or 0) + 1.0) / ((total.n or 0) + 2.0)


def host_reputation(pages: DataFrame, outcomes: DataFrame, conf: Reputation = Reputation()) -> DataFrame:
    """pages (page_id, host) and outcomes (page_id, bad 0/1) to (host, n, k, mean, bound, bad, and the means of domain and suffix).
    One row per host of pages; k of its n labelled pages are bad; bad: bound is beyond the threshold."""
    p, o = pages.select("page_id", "host").alias("p"), outcomes.select("page_id", "bad").alias("o")
    counted = (
        p.join(o, F.col("p.page_id") == F.col("o.page_id"), "left")
        .groupBy(F.col("p.host").alias("host")).agg(F.count("o.bad").alias("n"), F.coalesce(F.sum("o.bad"), F.lit(0)).cast("long").alias("k"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    )
    hosts = staged(counted, "hosts")
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    p0 = base_rate(hosts)
    m_suffix = strength(suffixes.withColumn("all", F.lit(0)), "all", conf.default_strength)
    m_domain = strength(domains, "suffix", conf.default_strength)
    m_host = strength(hosts, "domain", conf.default_strength)
    post = lambda m, prior: (F.col("k") + m * prior) / (F.col("n") + m)
    s = suffixes.select("suffix", post(F.lit(m_suffix), F.lit(p0)).alias("suffix_mean"))
    d = domains.join(s, "suffix").select("domain", post(F.lit(m_domain), F.col("suffix_mean")).alias("domain_mean"), "suffix_mean")
    h = hosts.join(d, "domain").withColumn("mean", post(F.lit(m_host), F.col("domain_mean")))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + m_host + 1))
    h = h.withColumn("bound", F.col("mean") - conf.z * sd)
    return h.select("host", "n", "k", "mean", "bound", (F.col("bound") > min(conf.most, conf.ratio * p0)).alias("bad"), "domain_mean", "suffix_mean")


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, conf: Reputation = Reputation()) -> DataFrame:
    """pages (page_id, url), outcomes (page_id, bad) to (page_id, host, path, rule, verdict, bad_bound,
    bad_mean, domain_mean, suffix_mean): the bound and the posterior means of the page's host, domain and suffix."""
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = host_reputation(cut, outcomes, conf).select(F.col("host").alias("h"), F.col("bound").alias("bad_bound"), F.col("mean").alias("bad_mean"), "domain_mean", "suffix_mean", "bad")
    out = cut.join(judged, F.col("host") == F.col("h"), "left")
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_bound", "bad_mean", "domain_mean", "suffix_mean")


def outcomes_of(labels: DataFrame) -> DataFrame:
    """Page outcomes from labels, whose doc_id names the page: bad if toxic or of no quality."""
    bad = F.when(F.col("toxic").isNull() & F.col("quality").isNull(), None).when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
