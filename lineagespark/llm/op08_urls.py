"""URL filters: rules first, then the reputation of the host.

Labelled outcomes of pages are counted per host, registered domain and suffix. Each level is a
beta-binomial: the mean of the level above is its prior, with a strength estimated by the method
of moments over all groups of the level, so a host with few labels takes after its domain. A url
is blocked when the lower bound of its host's posterior share of bad pages passes the threshold;
one without evidence is allowed.

Null urls, or urls without ``://``, have an empty host and path: no rule fits, the verdict is the
method's for an unknown host. Repeated rows are judged alone; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Labels that stand before a country's label as part of a public suffix.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
MAX_BAD, Z = 0.5, 1.6449
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.split_part(F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column, host: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3 + F.length(host), F.length(url))).otherwise(F.lit(""))
    return F.coalesce(F.split_part(F.split_part(rest, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where they form a public suffix of a country."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    second = F.try_element_at(labels, n - 1)
    deep = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & second.isin(*SECOND_LEVEL)
    return F.when(deep, F.concat_ws(".", second, F.element_at(labels, -1))).otherwise(F.element_at(labels, -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it."""
    kept = F.size(F.split(suffix, "\\.")) + 1
    return F.array_join(F.slice(F.split(host, "\\."), F.greatest(F.lit(1), F.size(F.split(host, "\\.")) - kept + 1), kept), ".")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does. The list is a parameter."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _strength(counts: DataFrame, parent: str, out: str) -> DataFrame:
    """One row: how many labels the prior of a level is worth, from how its groups vary.

    With n labels, prior mean m and strength k, the squared error of a group's share is
    m(1-m)/n * (1 + (n-1)/(k+1)) on average; summed over groups, that gives 1/(k+1).
    """
    usual = F.col(parent) * (1 - F.col(parent))
    error = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col(parent), 2)
    rho = F.when(F.sum(usual * (F.col("n") - 1)) > 0, F.sum(error - usual) / F.sum(usual * (F.col("n") - 1)))
    k = 1 / F.greatest(rho, F.lit(1e-9)) - 1
    return counts.agg(F.coalesce(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), k)), F.lit(MAX_STRENGTH)).alias(out))


def _level(counts: DataFrame, parent: str, mean: str) -> DataFrame:
    """``counts`` with the posterior mean of its groups and the strength they were shrunk with."""
    k = f"_k_{mean}"
    return counts.crossJoin(F.broadcast(_strength(counts, parent, k))).withColumn(mean, (F.col("bad") + F.col(k) * F.col(parent)) / (F.col("n") + F.col(k)))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``outcomes(host, bad 0/1)`` to ``(host, n, bad, mean, lower)``.

    Counts are partial aggregates, so a host with a third of the pages is no hot key; every level
    has one row per group, and the crossed tables have one row.
    """
    names = outcomes.filter("host <> '' AND bad IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    hosts = names.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    overall = domains.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("m0"))
    suffixes = _level(domains.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(overall)), "m0", "m1").select("suffix", "m1")
    middle = _level(domains.join(suffixes, "suffix"), "m1", "m2").select("domain", "m2")
    low = _level(hosts.join(middle, "domain"), "m2", "m3")
    strength = F.col("n") + F.col("_k_m3")
    spread = F.sqrt(F.col("m3") * (1 - F.col("m3")) / (strength + 1))
    return low.select("host", "n", "bad", F.col("m3").alias("mean"), (F.col("m3") - Z * spread).alias("lower"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """``(page_id, host, path, rule, verdict, n_labelled)`` of every page.

    ``labels(doc_id, quality, toxic)`` name outcomes by page: bad when of quality 0 or toxic.
    """
    host = host_of(F.col("url"))
    base = pages.select("page_id", host.alias("host"), path_of(F.col("url"), host).alias("path"))
    # Null outcomes count for nothing; several labels of one page count as one, the worst.
    bad = F.greatest(F.when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 0), F.when(F.col("toxic") == 1, 1).when(F.col("toxic").isNotNull(), 0))
    worst = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = host_reputation(base.select("page_id", "host").join(worst, "page_id").select("host", "bad"))
    name, said = rule_of(F.col("host"), F.col("path"), rules)
    judged = base.join(known.select("host", F.col("n").cast("long").alias("n_labelled"), "lower"), "host", "left")
    method = F.when(F.col("lower") > max_bad, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(said, method).alias("verdict"), F.coalesce("n_labelled", F.lit(0)).cast("long").alias("n_labelled"))
