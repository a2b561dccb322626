"""URL filter: allow and block rules, then empirical-Bayes host reputation. DataFrame operations only.

Rules decide first: a rule is a host and a path; it fits its host and all subdomains if the url's path starts with the
rule's, and the longest fitting rule wins (block wins a tie).

Other urls are judged by their host, without a port. Labelled page outcomes (bad or not) are counted by host. Rates are shrunk along
suffix -> registered domain -> host: the prior of a group is a beta distribution whose mean is its parent's posterior mean
and whose weight is fitted at that level by the method of moments, from the beta-binomial variance
E[n (p - mean)^2 / (mean (1 - mean))] = 1 + (n - 1) rho, weight = 1 / rho - 1. A host is blocked if the lower bound
of its posterior bad rate, the `level` quantile of the beta distribution, exceeds `block_rate`. Quantiles are computed once for each
distinct posterior, and only where the mean is above (1 - level) * block_rate: under that the bound can't exceed block_rate.

The suffix is the longest ending of the host in `suffixes` (a table of endings with two labels or more, such as a public suffix
list), else its last label; the registered domain has one label more. Hosts that are addresses (IPv4, or in brackets) are domains of
their own, under one suffix.

Only the three fitted numbers of each level come to the driver. Counts are summed before any shuffle, so one host may hold
any share of the pages; the join back is an ordinary one that the engine may split where it is skewed.

Cases: host and path of a null url, or one without `://`, are empty, and such pages count as one host of that name. Pages
with a null id stay, unlabelled. Repeated pages count and return each. An id with several labels is bad if any says so. Of rules of
equal length that fit, a blocking one wins.
Without outcomes every host has the prior's mean 1/2 and bound below it. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .beta import quantile
from .common import as_table

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Suffixes of two labels that are known without a table; all others have one.
SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "com.cn", "co.in", "co.kr", "co.nz", "co.za", "gov.uk", "org.uk")
LEVEL = 0.05
BLOCK_RATE = 0.5
#: The suffix of hosts that are addresses; no name has it.
ADDRESS = "[]"
RHO = (0.001, 0.5)
MEAN = (0.001, 0.999)


def parts(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits, else nulls."""
    verdict = rule = F.lit(None).cast("string")
    # The last `when` that is wrapped around is asked first: shortest rules go innermost, block outside allow.
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def name_of(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def domains(names: DataFrame, suffixes: DataFrame) -> DataFrame:
    """name, domain, suffix for each row of names (name, distinct)."""
    labels = F.split("name", r"\.")
    size = F.size(labels)
    ending = lambda k: F.array_join(F.slice(labels, -k, k), ".")
    endings = names.select("name", F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(6), size)))).alias("k")).where(F.size(F.split("name", r"\.")) >= F.col("k"))
    longest = endings.withColumn("suffix", ending(F.col("k"))).join(suffixes.select("suffix").distinct(), "suffix", "left_semi").groupBy("name").agg(F.max("k").alias("k"))
    address = F.col("name").startswith("[") | F.col("name").rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    k = F.coalesce("k", F.lit(1))
    out = names.join(longest, "name", "left")
    return out.select("name", F.when(address, F.col("name")).otherwise(ending(F.least(size, k + 1))).alias("domain"), F.when(address, F.lit(ADDRESS)).otherwise(ending(k)).alias("suffix"))


def clip(x: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.greatest(x, F.lit(bounds[0])), F.lit(bounds[1]))


def weight(groups: DataFrame, mean: Column) -> float:
    """The prior's weight for groups with counts n and bad around their means."""
    p, m = F.col("bad") / F.col("n"), clip(mean, MEAN)
    s, total, number = groups.where("n > 0").agg(F.sum(F.col("n") * (p - m) * (p - m) / (m * (1 - m))), F.sum("n"), F.count("*")).first()
    rho = (s - number) / (total - number) if s is not None and total > number else RHO[1]
    return 1 / min(max(rho, RHO[0]), RHO[1]) - 1


def posterior(groups: DataFrame, mean: Column, name: str) -> DataFrame:
    """Adds `name`, the posterior mean of the bad rate, and `<name>_weight`, the posterior's weight."""
    w = weight(groups, mean)
    return groups.withColumn(name, (clip(mean, MEAN) * w + F.col("bad")) / (w + F.col("n"))).withColumn(f"{name}_weight", w + F.col("n"))


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes: DataFrame) -> DataFrame:
    """A row per name: name, n (labelled pages), bad, rate (posterior mean), rate_weight. pages: page_id, name; outcomes: page_id, bad (0/1)."""
    outcomes = outcomes.groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = pages.where(F.col("page_id").isNotNull()).join(outcomes, "page_id").groupBy("name").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    names = as_table(pages.select("name").distinct(), "names")
    hosts = as_table(domains(names, suffixes).join(labelled, "name", "left").na.fill(0, ["n", "bad"]), "hosts")
    by_domain = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = by_suffix.agg(F.sum("n"), F.sum("bad")).first()
    top = F.lit(bad / n if n else 0.5)
    by_suffix = posterior(by_suffix, top, "suffix_rate").select("suffix", "suffix_rate")
    by_domain = posterior(by_domain.join(by_suffix, "suffix"), F.col("suffix_rate"), "domain_rate").select("domain", "domain_rate")
    return posterior(hosts.join(by_domain, "domain"), F.col("domain_rate"), "rate").select("name", "n", "bad", "rate", "rate_weight")


def with_bound(hosts: DataFrame, level: float, block_rate: float) -> DataFrame:
    """Adds `low`, the level quantile of the posterior; null where the mean shows that it is under block_rate.

    P(X > low) = 1 - level, so the mean is at least (1 - level) * low (Markov)."""
    hosts = as_table(hosts, "reputation")
    asked = hosts.where(F.col("rate") > (1 - level) * block_rate).select("rate", "rate_weight").distinct()
    a, b = F.col("rate") * F.col("rate_weight"), (1 - F.col("rate")) * F.col("rate_weight")
    bounds = asked.select("rate", "rate_weight", a.alias("a"), b.alias("b")).select("rate", "rate_weight", quantile(F.col("a"), F.col("b"), level).alias("low"))
    return hosts.join(as_table(bounds, "bounds"), ["rate", "rate_weight"], "left")


def suffix_table(spark: SparkSession, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, suffixes))).alias("suffix"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, *, suffixes: DataFrame | None = None, level: float = LEVEL, block_rate: float = BLOCK_RATE) -> DataFrame:
    """page_id, host, path, rule, verdict, labelled and bad (the host's counts), low (the bound, where it could exceed block_rate)."""
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), name_of(host).alias("name"))
    hosts = reputation(urls, outcomes, suffix_table(pages.sparkSession) if suffixes is None else suffixes)
    hosts = with_bound(hosts, level, block_rate).select("name", F.col("n").alias("labelled"), "bad", "low", F.when(F.col("low") > block_rate, "block").otherwise("allow").alias("judged"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return urls.join(hosts, "name", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("judged")).alias("verdict"), "labelled", "bad", "low")


def judge_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Judges every url; the labels of a page are those with its id, and an outcome is bad if toxic or of low quality."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)
    return judge(pages, labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("page_id"), bad.alias("bad"))).drop("low")
