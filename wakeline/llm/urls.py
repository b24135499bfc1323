"""URL filters: rules first, then the reputation of the host.

Rules are (verdict, host, path): a rule fits its host and all subdomains where
the url's path starts with the rule's; the longest one (host and path) wins.

Reputation: labelled pages are counted by host, registered domain and suffix.
At every level the share of bad pages is shrunk towards the level above by a
beta-binomial prior: the prior's mean is the posterior mean above, its strength
comes from the intraclass correlation among the level's members (the analysis of
variance estimator, kept within 0.001 and 0.999; 0.1 where it is undefined). A
url without a rule is blocked if the lower bound of its host's posterior (mean
less ``Z`` standard deviations of the beta) is over ``LEAST``.

Hosts: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on up to ``?`` or ``#``. A null url, or one without
``://``, has an empty host and path; an empty host is judged like any other. A
label with a null counts as none; a page labelled more than once is bad if any
label is. Only page id and url are read, and counts are combined before they
are shuffled, so a host with a third of all pages is one row. Ties in rule
length go to the first rule. Repeated rows each get their verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Z = 1.645
LEAST = 0.5

#: Second-level public suffixes that count as one suffix.
PUBLIC = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""

    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _shrunk(members: DataFrame, parent: DataFrame, key: str, up: str) -> DataFrame:
    """(key, up, n, bad, mean, strength): ``members`` (key, up, n, bad) with the
    posterior mean, given the parents' (up, mean)."""

    fit = members.filter("n > 0").agg(
        F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.count("*").alias("k"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("n2"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"),
    ).selectExpr(
        "(b2 - all_bad * all_bad / all_n) / (k - 1D) AS msb", "(all_bad - b2) / (all_n - k + 0D) AS msw",
        "(all_n - n2 / all_n) / (k - 1D) AS n0", "k", "all_n",
    ).selectExpr("CASE WHEN k > 1 AND all_n > k AND msb + (n0 - 1) * msw > 0"
                 " THEN least(0.999D, greatest(0.001D, (msb - msw) / (msb + (n0 - 1) * msw))) ELSE 0.1D END AS rho"
                 ).selectExpr("1 / rho - 1 AS strength")
    above = parent.select(F.col(up).alias("_up"), F.col("mean").alias("above"))
    return members.crossJoin(F.broadcast(fit)).join(above, F.col(up) == F.col("_up")).select(  # fit: one row
        key, up, "n", "bad", ((F.col("bad") + F.col("strength") * F.col("above")) / (F.col("n") + F.col("strength"))).alias("mean"), "strength")


def reputation(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """(host, n, bad, mean, bound): the posterior of the share of bad pages of
    every host of ``pages``, bound being its lower bound."""

    bad = labels.filter(f"{label_id} IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col(label_id).alias("_id")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    seen = pages.select(F.col(id_col).alias("id"), parts(F.col(url_col))[0].alias("host")).join(bad, F.col("id") == F.col("_id"), "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    two = F.substring_index("host", ".", -2)
    suffix = F.when(two.isin(*PUBLIC), two).otherwise(F.substring_index("host", ".", -1))
    domain = F.when(two.isin(*PUBLIC), F.substring_index("host", ".", -3)).otherwise(two)
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("top", F.lit("all"))
    top = suffixes.groupBy("top").agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("mean"))
    s = _shrunk(suffixes, top, "suffix", "top")
    d = _shrunk(domains, s, "domain", "suffix")
    h = _shrunk(hosts, d, "host", "domain")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1))
    return h.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(Z) * spread).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """(id_col, host, path, rule, verdict) of every page."""

    host, path = parts(F.col(url_col))
    rule = verdict = None
    for kind, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)
        rule = F.when(fits, name + start) if rule is None else rule.when(fits, name + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    known = reputation(pages, labels, id_col, url_col, label_id).select(F.col("host").alias("_host"), "bound")
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    none = F.lit(None).cast("string")
    return rows.join(known, F.col("host") == F.col("_host"), "left").select(
        id_col, "host", "path", (none if rule is None else rule).alias("rule"),
        F.coalesce(none if verdict is None else verdict, F.when(F.col("bound") > F.lit(LEAST), "block").otherwise("allow")).alias("verdict"))
