"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix. Each
level has a beta-binomial prior centred on the posterior mean of the level above (host ->
registered domain -> suffix -> all pages); its strength is estimated from the spread of the
rates on that level by the method of moments. A URL is blocked when the lower bound of its
host's posterior bad rate is over the threshold: a host is blocked on evidence, never for
lack of it. Rules on (host, path) come first; the longest fitting rule wins.

All steps are aggregations and equi-joins on keys; a host that holds a third of all pages
is combined map-side, and the join back is a plain shuffle join that AQE splits.

Defined cases: a null url, or one without ``://``, has empty host and path and is judged
by the rates of all such pages; a null or missing label is no evidence; repeated pages are
judged alike; repeated labels of a page count once, bad if any is; an empty pages table
gives an empty result; other columns are carried in ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered; all others have one label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "org.uk")


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    """The suffix and one label more."""
    two = F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict (nulls if none fits). A rule
    ``example.net/en/`` fits that host and its subdomains where the path starts with ``/en/``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, action in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rhost, rpath = text.split("/", 1)
        fits = ((host == rhost) | host.endswith("." + rhost)) & path.startswith("/" + rpath)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _strength(level: DataFrame) -> Column:
    """The strength (pseudo-count) of the prior on a level, from the weighted spread of its rates
    beyond what binomial noise explains; kept within 1 and 1000. A scalar subquery."""
    s = level.filter("n > 0").agg(
        F.count(F.lit(1)).alias("j"), F.sum("n").alias("tn"), F.sum("bad").alias("tb"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"))
    m = F.col("tb") / F.col("tn")
    spread = F.col("q") / F.col("tn") - m * m - m * (1 - m) * F.col("j") / F.col("tn")
    k = m * (1 - m) / spread - 1
    return s.select(F.when(F.coalesce(F.col("tn"), F.lit(0)) == 0, 1.0).when(spread <= 0, 1000.0)
                    .otherwise(F.least(F.lit(1000.0), F.greatest(F.lit(1.0), k))).alias("k")).scalar()


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """``outcomes(host, n, bad)``, one row per host -> ``host, n, bad, mean, bound``."""
    hosts = outcomes.select("host", "n", "bad", registered_domain(F.col("host")).alias("domain"),
                            url_suffix(F.col("host")).alias("suffix"))
    add = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    m0 = suffixes.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m0")).scalar()
    s = suffixes.withColumns({"k": _strength(suffixes), "m0": m0}) \
        .select("suffix", ((F.col("bad") + F.col("k") * F.col("m0")) / (F.col("n") + F.col("k"))).alias("ms"))
    d = domains.join(s, "suffix").withColumn("k", _strength(domains)) \
        .select("suffix", "domain", ((F.col("bad") + F.col("k") * F.col("ms")) / (F.col("n") + F.col("k"))).alias("md"))
    h = hosts.join(d, ["suffix", "domain"]).withColumn("k", _strength(hosts)).select(
        "host", "n", "bad", (F.col("bad") + F.col("k") * F.col("md")).alias("a"),
        (F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("md"))).alias("b"))
    mean, total = F.col("a") / (F.col("a") + F.col("b")), F.col("a") + F.col("b")
    return h.select("host", "n", "bad", mean.alias("mean"),
                    (mean - z * F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = (),
               page_col: str = "page_id", url_col: str = "url", threshold: float = 0.5,
               z: float = 1.645) -> DataFrame:
    """``row`` (the page as a struct), ``host, path, rule, verdict, host_labelled, host_bad, bound``.

    ``labels(page_id, bad)``: labelled outcomes by page id (``bad`` 0, 1 or null)."""
    packed = pages.select(F.struct("*").alias("row"), F.col(page_col).alias("page"),
                          url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    known = labels.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy(F.col("page_id").alias("page")) \
        .agg(F.max("bad").cast("long").alias("bad"))
    outcomes = packed.select("page", "host").join(known, "page", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    rep = materialise(host_reputation(materialise(outcomes, "url-hosts"), z), "url-reputation")
    rule, by_rule = rule_for(F.col("host"), F.col("path"), rules)
    return packed.join(rep.hint("merge"), "host").select(
        "row", "host", "path", rule.alias("rule"),
        F.coalesce(by_rule, F.when(F.col("bound") > threshold, "block").otherwise("allow")).alias("verdict"),
        F.col("n").alias("host_labelled"), F.col("bad").alias("host_bad"), "bound")
