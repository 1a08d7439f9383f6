"""URL filters: list rules first, empirical-Bayes host reputation for the rest.

A list of (host, path) rules decides a page outright.  These decided pages are
the labelled outcomes (blocked or allowed) from which the reputation of hosts is
estimated, unless the caller brings outcomes of its own.  A host's share of
blocked pages is shrunk towards that of its registered domain, the domain's
towards its suffix's, the suffix's towards that of all pages: each level has a
beta-binomial prior whose mean is the parent's posterior mean and whose strength
is estimated from how far the children of that level differ (moments).  A page
without a rule is blocked if the lower posterior bound of its host's share
reaches a limit.

DataFrame functions only.  Outcomes are counted per host before the first
shuffle, so a hot host is one row per task; a hot domain or host on the large
side of a join is salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, salted_left_join

#: The rules of the contract, (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Suffixes of two labels under which names are registered; any other suffix is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "com.cn")
#: Share of blocked pages that the lower posterior bound must reach, and the bound's distance in standard deviations.
LIMIT, DEVIATIONS = 0.5, 1.645
#: Correlation between pages of one parent is kept inside these; the one taken where no child has two outcomes.
LEAST, MOST, UNKNOWN = 0.001, 0.999, 0.5
#: Estimated correlations are rounded to so many digits, so that the order of sums does not show.
DIGITS = 9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/``, ``?`` or ``#`` with A-Z lower-cased; both
    empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    shape = r"^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, shape, 1), _UPPER, _LOWER), F.regexp_extract(rest, shape, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null.

    Of rules of one length that with the longer host wins, then the first in text order.
    """
    def parts(rule: str) -> tuple[str, str]:
        at = rule.index("/")
        return rule[:at], rule[at:]

    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), len(parts(r[1])[0]), [-ord(c) for c in r[1]])):
        name, start = parts(rule)
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """(domain, suffix) of a host, without user and port; a number address is its own domain under no suffix."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    name = F.rtrim(name, F.lit("."))
    address = name.rlike(r"^\d+(\.\d+){3}$") | name.startswith("[")
    two = F.substring_index(name, ".", -2)
    wide = two.isin(list(suffixes)) if suffixes else F.lit(False)
    suffix = F.when(address, "").when(wide, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address, name).when(wide, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, suffix


def _correlation(children: DataFrame) -> float:
    """Correlation of two pages of one child, over all children of a level, by moments.

    A child of ``n`` outcomes, ``bad`` of them blocked, under a parent's mean
    ``m`` has E[n (bad / n - m)^2] = m (1 - m) (1 + (n - 1) rho).
    """
    n, bad, m = F.col("n"), F.col("bad"), F.col("m")
    v = m * (1 - m)
    over = F.sum(F.round(n * (bad / n - m) * (bad / n - m) - v, DIGITS).cast("decimal(38,9)"))
    room = F.sum(F.round(v * (n - 1), DIGITS).cast("decimal(38,9)"))
    got = children.where("n > 0").agg(over.cast("double").alias("over"), room.cast("double").alias("room")).first()
    if not got["room"] or got["room"] <= 0:
        return UNKNOWN
    return round(min(MOST, max(LEAST, got["over"] / got["room"])), DIGITS)


def _shrunk(children: DataFrame) -> DataFrame:
    """Children (.., n, bad, m) with their posterior: ``mean`` and ``weight`` (prior strength and outcomes)."""
    rho = _correlation(children)
    strength = F.lit((1 - rho) / rho)
    return children.withColumn("weight", strength + F.col("n")).withColumn(
        "mean", (strength * F.col("m") + F.col("bad")) / F.col("weight"))


def reputation(outcomes: DataFrame, limit: float = LIMIT, deviations: float = DEVIATIONS,
               suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, n, bad, mean, bound, blocked) for each host of ``outcomes`` (host, blocked).

    ``blocked`` is 1, 0 or null; null outcomes are not counted, their hosts get
    a posterior from the levels above.  ``bound`` is the posterior mean less
    ``deviations`` standard deviations.  Only three correlations and the grand
    total come to the driver.
    """
    domain, suffix = registered(F.col("host"), suffixes)
    count = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    hosts = materialize(
        outcomes.groupBy("host").agg(F.count("blocked").alias("n"),
                                     F.coalesce(F.sum("blocked"), F.lit(0)).cast("long").alias("bad"))
        .withColumn("domain", domain).withColumn("suffix", suffix), "url-hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(*count), "url-domains")
    ends = domains.groupBy("suffix").agg(*count)
    grand = domains.agg(*count).first()
    mean = ((grand["bad"] or 0) + 1) / ((grand["n"] or 0) + 2)

    ends = _shrunk(ends.withColumn("m", F.lit(mean)))
    domains = materialize(_shrunk(salted_left_join(
        domains, ends.select("suffix", F.col("mean").alias("m")), ["suffix"], F.xxhash64("domain"))), "url-domains")
    hosts = _shrunk(materialize(salted_left_join(
        hosts, domains.select("domain", "suffix", F.col("mean").alias("m")), ["domain", "suffix"], F.xxhash64("host")),
        "url-hosts"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return hosts.withColumn("bound", F.col("mean") - F.lit(float(deviations)) * deviation).select(
        "host", "n", "bad", "mean", "bound", (F.col("bound") >= limit).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str]] = RULES, **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_outcomes, host_blocked, bound) per row of ``pages``.

    ``outcomes`` (host, blocked) are labelled pages; without them the pages that
    a rule decides are.  A null url, or one without ``://``, has an empty host
    and path, fits no rule and is judged like any host without outcomes.
    Without any outcome no page is blocked by reputation.  Repeated rows and
    null ids give a row each; an empty table gives an empty result; other
    columns, whatever their names, are not read.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("int"))
    seen = rows.select("host", (ruled if outcomes is None else F.lit(None).cast("int")).alias("blocked"))
    if outcomes is not None:
        seen = seen.union(outcomes.select("host", F.col("blocked").cast("int")))
    known = materialize(reputation(seen, **options), "url-reputation")
    judged = salted_left_join(rows, known, ["host"], F.xxhash64("page_id", "path"))
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.verdict", own).alias("verdict"),
                         F.col("n").alias("host_outcomes"), F.col("bad").alias("host_blocked"),
                         F.round("bound", 6).alias("bound"))
