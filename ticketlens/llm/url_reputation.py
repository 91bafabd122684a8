"""URL filter by rules and by empirical-Bayes host reputation, all in DataFrame functions.

Labelled pages give each host a count of bad outcomes. A host's bad rate is shrunk through
beta-binomial priors: suffix towards all pages, registered domain towards its suffix, host towards
its domain. How strongly each level shrinks is estimated from the spread between its members (method
of moments). A host is blocked when even the lower bound of its posterior rate is above a limit.

Scale: only (id, url) is read. Everything about hosts is aggregated to one row per host map side,
rules are matched on distinct hosts by an equi-join on host suffixes, and pages get their host's row
by one join, where adaptive execution splits a host with a third of all pages. The driver sees four
numbers.

Defined cases: a null url, or one without ``://``, has an empty host and path; so has a host of no
characters; these are judged like the other hosts. A very long url is judged whole, its host being one key as any. Repeated rows are judged each. Without outcomes
every rate is the prior's and nothing but the rules blocks. Rules that are as long are taken in
code point order. Columns that the operator adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

#: Public suffixes of two labels (fixed values; a parameter where another list is wanted).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp",
                      "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr",
                      "co.nz", "co.za")
BLOCK_RATE = 0.5
BOUND_Z = 1.645  # one-sided 95 %


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://``, and the path up to the query or fragment."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def domain_and_suffix(host: Column, two_label: Iterable[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix (a bare or numeric host is its own domain)."""
    last_two = F.substring_index(host, ".", -2)
    double = last_two.isin(*two_label)
    numeric = host.rlike(r"^[0-9.:\[\]]+$")
    suffix = F.when(numeric, host).when(double, last_two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(numeric, host).when(double, F.substring_index(host, ".", -3)).otherwise(last_two)
    return domain, suffix


def _spread_to_strength(rows: DataFrame, n: str, x: str, mean: str) -> float:
    """Prior strength (pseudo-pages) of a level: beta-binomial moments of its members' counts."""
    noise = F.col(n) * F.col(mean) * (1 - F.col(mean))
    got = rows.where(F.col(n) > 0).agg(
        F.sum(F.pow(F.col(x) - F.col(n) * F.col(mean), 2) - noise).alias("over"),
        F.sum(noise * (F.col(n) - 1)).alias("room")).first()
    rho = (got["over"] or 0.0) / got["room"] if got["room"] else 0.0
    rho = min(max(rho, 0.002), 0.5)
    return 1 / rho - 1


def reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, bad) rows -> posterior mean and lower bound of each host's bad rate."""
    domain, suffix = domain_and_suffix(F.col("host"))
    base = materialise(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    total = base.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)

    def level(key: str, *also: str) -> DataFrame:
        return base.groupBy(key, *also).agg(F.sum("n").alias(f"n_{key}"), F.sum("bad").alias(f"x_{key}"))

    def shrunk(rows: DataFrame, key: str, mean: str) -> DataFrame:
        k = _spread_to_strength(rows, f"n_{key}", f"x_{key}", mean)
        return rows.withColumn(f"p_{key}", (F.col(f"x_{key}") + k * F.col(mean)) / (F.col(f"n_{key}") + k))

    suffixes = shrunk(level("suffix").withColumn("p_all", F.lit(float(overall))), "suffix", "p_all")
    domains = shrunk(level("domain", "suffix").join(suffixes.select("suffix", "p_suffix"), "suffix"),
                     "domain", "p_suffix")
    out = base.join(domains.select("domain", "p_domain", "p_suffix"), "domain")
    k = _spread_to_strength(out, "n", "bad", "p_domain")
    a = F.col("bad") + k * F.col("p_domain")
    b = F.col("n") - F.col("bad") + k * (1 - F.col("p_domain"))
    mean = a / (a + b)
    sd = F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return out.select("host", "domain", "suffix", "n", "bad", mean.alias("bad_rate"),
                      F.greatest(mean - BOUND_Z * sd, F.lit(0.0)).alias("bad_rate_low"))


def judge(pages: DataFrame, rules: DataFrame, outcome: Column | None = None, url_col: str = "url",
          block_rate: float = BLOCK_RATE) -> DataFrame:
    """``pages`` without its url but with host, path, rule, verdict and the host's reputation.

    ``rules`` has (verdict, rule) with rules like ``net/`` or ``example.org/en/``: a rule fits its
    host and all subdomains if the path starts with its path, and the longest wins. ``outcome`` is a
    boolean column of ``pages``: true for a bad page, null for one without a label."""
    added = ("host", "path", "rule", "verdict", "bad_rate", "bad_rate_low")
    host, path = host_and_path(F.col(url_col))
    mark = F.lit(None).cast("boolean") if outcome is None else outcome
    kept = [c for c in pages.columns if c.lower() not in (*added, url_col.lower())]
    pre = unused_prefix(pages)
    rows = pages.select(*kept, host.alias("host"), path.alias("path"), mark.alias(pre + "bad"))
    hosts = rows.groupBy("host").agg(F.count(pre + "bad").alias("n"),
                                     F.count(F.when(F.col(pre + "bad"), 1)).alias("bad"))
    known = reputation(hosts)

    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    split = F.instr("rule", "/")
    fixed = rules.select(F.col("verdict").alias("rule_verdict"), "rule",
                         F.substr("rule", F.lit(1), split - 1).alias("rule_host"),
                         F.substr("rule", split).alias("rule_path"))
    fitting = (known.select("host", F.explode(suffixes).alias("rule_host")).join(fixed, "rule_host")
               .groupBy("host").agg(F.collect_list(F.struct(
                   (-F.length("rule")).alias("order"), "rule", "rule_path", "rule_verdict")).alias("rules")))
    known = known.join(fitting, "host", "left").select(
        F.col("host").alias(pre + "host"), F.col("rules").alias(pre + "rules"), F.col("bad_rate").alias(pre + "rate"),
        F.col("bad_rate_low").alias(pre + "low"))
    out = rows.join(known, F.col("host") == F.col(pre + "host"), "left")
    fits = F.filter(pre + "rules", lambda r: F.col("path").startswith(r["rule_path"]))
    out = out.withColumn(pre + "rule", F.array_min(fits))  # the longest, as `order` is minus the length
    blocked = F.col(pre + "low") > block_rate
    verdict = F.coalesce(F.col(pre + "rule")["rule_verdict"], F.when(blocked, "block").otherwise("allow"))
    return out.select(*kept, "host", "path", F.col(pre + "rule")["rule"].alias("rule"), verdict.alias("verdict"),
                      F.col(pre + "rate").alias("bad_rate"), F.col(pre + "low").alias("bad_rate_low"))
