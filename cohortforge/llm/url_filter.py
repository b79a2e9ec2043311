"""URL filter: host rules first, else the empirical-Bayes reputation of the host.

Reputation: labelled outcomes of pages are counted per host, registered domain and suffix. Each level's
bad rate is a beta-binomial posterior mean shrunk to the level above (host to domain, domain to suffix,
suffix to the whole), with the strength of each prior estimated by moments from the spread of the rates
at that level. A host is blocked when the lower bound of its posterior bad rate, mean minus ``z`` standard
deviations, lies above ``max_bad``: few labels keep a host near its parents and its bound low.

Edge cases: a null url or one without ``://`` has empty host and path and is judged by the reputation of
the empty host; pages without label count for nothing; repeated labels of a page count once (bad if any is);
with no labels at all every page that no rule fits is allowed; repeated rows stay; null ids never have labels; very long
urls are cut like others; an empty table gives no rows; columns beside page_id and url are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Suffixes of several labels; every other suffix is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
MOST_STRENGTH = 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Lower-cased host after the first ``://``, and path; both empty where there is none."""
    part = lambda i: F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (host/path, verdict) that fits, null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; user and port don't count."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    long = F.lit(False)
    for s in suffixes:
        long = long | (bare == s) | bare.endswith("." + s)
    return (F.when(long, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2)),
            F.when(long, F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1)))


def _strength(n: str, bad: str) -> list[Column]:
    """Prior strength of a level: how much the rates of its members spread beyond what chance gives."""
    total, hits = F.sum(n), F.sum(bad)
    rate = hits / total
    spread = F.sum(F.col(bad) * F.col(bad) / F.col(n)) - hits * hits / total
    between = (spread - (F.count("*") - 1) * rate * (1 - rate)) / F.nullif(total - F.sum(F.col(n) * F.col(n)) / total, F.lit(0.0))
    k = F.when(between > 0, rate * (1 - rate) / between - 1).otherwise(MOST_STRENGTH)
    return F.least(F.greatest(k, F.lit(1.0)), F.lit(MOST_STRENGTH))


def host_reputation(outcomes: DataFrame, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """outcomes (host, bad 0/1/null) -> (host, labelled, rate, bound) for every host."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("b"))
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("b").alias("db"))
    tops = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb"))
    # three numbers and two totals are all that the driver gets
    kh, total, hits = hosts.where("n > 0").agg(_strength("n", "b"), F.sum("n"), F.sum("b")).first()
    (kd,), (ks,) = domains.where("dn > 0").agg(_strength("dn", "db")).first(), tops.where("sn > 0").agg(_strength("sn", "sb")).first()
    joined = hosts.join(domains, ["domain", "suffix"]).join(tops, "suffix")
    kh, kd, ks, whole = (F.lit(x).cast("double") for x in (kh, kd, ks, hits / total if total else None))
    joined = joined.withColumn("ps", (F.col("sb") + ks * whole) / (F.col("sn") + ks))
    joined = joined.withColumn("pd", (F.col("db") + kd * F.col("ps")) / (F.col("dn") + kd))
    joined = joined.withColumn("rate", (F.col("b") + kh * F.col("pd")) / (F.col("n") + kh))
    bound = F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + kh + 1))
    return joined.select("host", F.col("n").cast("long").alias("labelled"), "rate", bound.alias("bound"))


def judge_pages(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], max_bad: float = 0.2, z: float = 1.645) -> DataFrame:
    """pages (page_id, url) and labels (page_id, bad) -> page_id, host, path, rule, verdict, bad_rate, bound."""
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    marks = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = host_reputation(urls.join(marks, "page_id", "left").select("host", "bad"), z)
    judged = urls.join(known, "host", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > max_bad, F.lit("block")).otherwise("allow")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        F.round("rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bound"),
    )
