"""Verdicts on urls: explicit rules first, then the host's reputation.

Labelled outcomes of pages (1: bad, 0: good) are summed per host. Beta-binomial
priors shrink a host's rate towards its registered domain's, a domain's towards
its suffix's, and a suffix's towards the rate of all pages; each level's prior
strength comes from the spread of its own rates (moment estimate). A page is
blocked if its host's rate of bad pages lies above a threshold even at the
lower end of its posterior.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.llm.common import free_name
from tidepanel.session import materialize

#: Second-level labels below which domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEVELS = ("suffix", "domain", "host")
#: Bounds of the intra-class correlation; its prior strength is (1 - rho) / rho.
RHO = (0.001, 0.999)


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end; A-Z lower-cased."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to `?`, `#` or the end."""
    whole = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    at = F.locate("/", whole)
    return F.when(at > 0, F.substr(whole, at)).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def registered(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; user and port are left out.

    The suffix is the last label, or the last two where the last has two
    letters and the one before is a known second level.
    """
    name = F.regexp_replace(F.substring_index(host, "@", -1), ":[0-9]*$", "")
    labels = F.split(name, "\\.")
    two = (F.length(F.element_at(labels, -1)) == 2) & (F.size(labels) > 2) & F.element_at(
        labels, F.when(F.size(labels) > 1, -2).otherwise(-1)
    ).isin(*SECOND_LEVEL)
    return (
        F.when(two, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2)),
        F.when(two, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1)),
    )


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(length, verdict, rule); null if none does.

    A rule (verdict, host, path) fits its host and its subdomains if the path
    starts with the rule's. Of equally long rules, a blocking one wins, then
    the greater text.
    """
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length: int, verdict: string, rule: string>")


def reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of the bad rate per host.

    `hosts` has a row per host: host, domain, suffix, n (labelled pages) and
    bad. Returns host, n, bad, mean and lower (mean less `z` deviations). Hosts
    without labelled pages have their domain's rate. Only three numbers per
    level reach the driver.
    """
    totals = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = totals["n"] or 0, totals["bad"] or 0
    parent = None
    for level in LEVELS:
        above = LEVELS[LEVELS.index(level) - 1] if level != LEVELS[0] else None
        keys = [level] if above is None else [level, above]
        units = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if above is None:
            units = units.withColumn("prior", F.lit((bad + 1.0) / (n + 2.0)))
        else:
            units = units.join(parent, above)
        p, m, k = F.col("prior"), F.col("n").cast("double"), F.col("bad").cast("double")
        within = p * (1 - p)
        spread = units.filter("n > 0").agg(
            F.sum((k - m * p) * (k - m * p) / m - within).alias("over"), F.sum(within * (m - 1)).alias("scale")
        ).first()
        rho = (spread["over"] or 0.0) / spread["scale"] if spread["scale"] else RHO[1]
        rho = min(max(rho, RHO[0]), RHO[1])
        strength = (1 - rho) / rho
        alpha, beta = strength * p + k, strength * (1 - p) + m - k
        units = units.withColumns({"alpha": alpha, "beta": beta}).withColumn(
            "mean", F.col("alpha") / (F.col("alpha") + F.col("beta"))
        )
        units = materialize(units.drop("prior"), f"reputation-{level}")
        parent = units.select(level, F.col("mean").alias("prior"))
    size = F.col("alpha") + F.col("beta")
    deviation = F.sqrt(F.col("alpha") * F.col("beta") / (size * size * (size + 1)))
    return units.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(z) * deviation).alias("lower"))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], outcome: Column | None = None,
    id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5, z: float = 1.645,
) -> DataFrame:
    """One row per page: its id, host, path, rule, verdict, and the host's posterior.

    `outcome` is the label of a page (1 bad, 0 good, null unknown), from its
    columns; by default the pages that a rule decides are the labelled ones.
    `labelled` and `bad` are the host's counts, `bad_rate` and `bad_lower` the
    posterior mean and bound. Null urls and urls without `://` have an empty host and path
    and share the reputation of the empty host. Null ids and repeated rows are
    kept; other columns are ignored; an empty table gives an empty result.
    """
    host, path = free_name(pages, "host"), free_name(pages, "path")
    parsed = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    best = rule_for(F.col(host), F.col(path), rules)
    if outcome is None:
        outcome = F.when(best["verdict"] == "block", 1).when(best["verdict"] == "allow", 0)
    rows = parsed.select(
        F.col(id_col), F.col(host).alias("host"), F.col(path).alias("path"),
        best["rule"].alias("rule"), best["verdict"].alias("ruled"), outcome.cast("long").alias("outcome"),
    )
    domain, suffix = registered(F.col("host"))
    hosts = (
        rows.groupBy("host")
        .agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    known = reputation(materialize(hosts, "hosts"), z).select(
        "host", F.col("n").alias("labelled"), "bad", F.col("mean").alias("bad_rate"), F.col("lower").alias("bad_lower")
    )
    by_method = F.when(F.col("bad_lower") > threshold, "block").otherwise("allow")
    return rows.join(known, "host").select(
        id_col, "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"),
        "labelled", "bad", "bad_rate", "bad_lower",
    )
