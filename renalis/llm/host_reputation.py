"""URL filter by host reputation: beta-binomial shrinkage from suffix to registered domain to host.

Labelled pages count as good or bad outcomes of their host. A host with few of them says little by
itself, so its rate is shrunk towards that of its registered domain, this towards its suffix, and that
towards all pages. How strongly is estimated from the data (empirical Bayes): by how much more the
rates of siblings vary than chance allows. A host is blocked if even the lower bound of its posterior
bad rate is above the tolerated one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renalis.session import Workspace

TOLERATED = 0.5  # share of bad pages
Z = 1.645  # one-sided 95 % bound
WEAK = 2.0  # pages that the prior of the suffixes weighs if they do not tell
SALTS = 16  # parts of a host's pages before their counts meet


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed rules of the registered query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty for a url that is null or has no `://`; else as written, A-Z of the host lower-cased."""
    tail = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", ""))
    tail = F.coalesce(tail, F.lit(""))
    bare = F.regexp_replace(tail, r"(?s)[?#].*$", "")
    host = F.substring_index(bare, "/", 1)
    path = F.substring(bare, F.length(host) + 1, F.length(bare))
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


ADDRESSES = "[address]"  # what numeric addresses have as their suffix; no label looks like it
DIGITS = 9  # of the rates that judge() returns, so that the order of additions does not show


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host: its last two labels, and its last.

    A user part, a port and a final dot do not count. A numeric address is a domain by itself.
    """
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"\.?(:[0-9]*)?$", "")
    numeric = bare.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$")
    domain = F.when(numeric, bare).otherwise(F.substring_index(bare, ".", -2))
    return domain, F.when(numeric, ADDRESSES).otherwise(F.substring_index(bare, ".", -1))


def _strength(p: Column, least: float = 1e-3) -> Column:
    """Strength of the prior that the siblings of a group share, null if they do not tell one.

    By moments: the weighted variance of the siblings' rates against what chance makes of their sizes
    leaves an intra-class correlation rho; the beta prior then weighs as much as 1 / rho - 1 pages.
    """
    between = (F.col("gkk") - F.col("gn") * p * p) / (F.col("g") - 1)
    within = (F.col("gk") - F.col("gkk")) / (F.col("gn") - F.col("g"))
    n0 = (F.col("gn") - F.col("gnn") / F.col("gn")) / (F.col("g") - 1)
    rho = F.try_divide(between - within, between + (n0 - 1) * within)
    usable = (F.col("g") > 2) & (F.col("gn") > F.col("g")) & (p > 0) & (p < 1)
    bounded = F.greatest(F.least(F.coalesce(rho, F.lit(1.0)), F.lit(0.9)), F.lit(least))
    return F.when(usable, 1 / bounded - 1)


def _siblings(rows: DataFrame, *key: str) -> DataFrame:
    """Strength `own` of the prior of each group of rows (n labelled, k bad)."""
    sums = rows.filter(F.col("n") > 0).groupBy(*key).agg(
        F.sum("n").cast("double").alias("gn"),
        F.sum("k").cast("double").alias("gk"),
        F.sum((F.col("n") * F.col("n")).cast("double")).alias("gnn"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("gkk"),
        F.count("*").alias("g"),
    )
    safe = F.when(F.col("g") > 1, F.col("gk") / F.col("gn"))
    return sums.filter((F.col("g") > 2) & (F.col("gn") > F.col("g"))).select(
        *key, _strength(safe).alias("own")
    )


def _posterior(rows: DataFrame) -> DataFrame:
    """rows with n, k, the mean `pm` and strength `ps` from above, and the siblings' own strength."""
    s = F.coalesce("own", "ps")
    return rows.withColumn("s", s).withColumn(
        "mean", (F.col("k") + F.col("pm") * s) / (F.col("n") + s)
    )


def reputations(
    outcomes: DataFrame, work: Workspace, tolerated: float = TOLERATED, z: float = Z
) -> DataFrame:
    """host, n, k, mean, lower, blocked for each host that has pages.

    outcomes: one row per page with its host and `bad` (0, 1, or null if unlabelled). The counts of a
    host are summed in each task first, so a host with most of the pages is no burden. Suffixes and
    domains get their own posteriors on the way down; a host without labels has that of its domain.
    """
    domain, suffix = levels(F.col("host"))
    hosts = work.cut(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
        .withColumn("domain", domain)
        .withColumn("suffix", suffix),
        "host_counts",
    )
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("suffix", "domain").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    # Above everything: all pages under Jeffreys' prior, and the strength that the suffixes share.
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    shared = _siblings(suffixes.withColumn("all", F.lit(1)), "all").first()
    strength = (shared and shared["own"]) or WEAK
    suffixes = _posterior(
        suffixes.select("suffix", "n", "k", F.lit(None).cast("double").alias("own"))
        .withColumn("pm", F.lit(mean))
        .withColumn("ps", F.lit(float(strength)))
    ).select("suffix", F.col("mean").alias("pm"), F.col("s").alias("ps"))
    domains = _posterior(
        domains.join(suffixes, "suffix").join(_siblings(domains, "suffix"), "suffix", "left")
    ).select("domain", F.col("mean").alias("pm"), F.col("s").alias("ps"))
    hosts = _posterior(
        hosts.join(domains, "domain").join(_siblings(hosts, "domain"), "domain", "left")
    )
    a = F.col("k") + F.col("pm") * F.col("s")
    b = F.col("n") - F.col("k") + (1 - F.col("pm")) * F.col("s")
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    lower = F.greatest(a / (a + b) - z * spread, F.lit(0.0))
    return hosts.select(
        "host", "n", "k", "mean", lower.alias("lower"), (lower > tolerated).alias("blocked")
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    work: Workspace,
    id_col: str = "page_id",
    url_col: str = "url",
    bad: Column | None = None,
    label_id_col: str = "doc_id",
    tolerated: float = TOLERATED,
) -> DataFrame:
    """id, host, path, rule, verdict, bad_rate, lower_bound for every page.

    The longest rule that fits decides; else the reputation of the host. Null urls and those without
    `://` have an empty host and path and are judged as one host. A page with several label rows is
    bad if any is; repeated pages each count. Without labels every host keeps the prior and is
    allowed unless a rule says otherwise. Other columns are not read.
    """
    bad = F.greatest(F.col("toxic"), 1 - F.col("quality")) if bad is None else bad
    host, path = host_and_path(F.col(url_col))
    seen = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    known = (
        labels.select(F.col(label_id_col).alias("id"), bad.cast("int").alias("bad"))
        .groupBy("id")
        .agg(F.max("bad").alias("bad"))
    )
    outcomes = seen.select("id", "host").join(known, "id", "left")
    known_hosts = reputations(outcomes, work, tolerated)
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    # The pages of a host are dealt to SALTS keys, each of which gets a copy of the host's one row.
    salted = seen.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int"))
    copies = known_hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    judged = salted.join(copies, ["host", "salt"], "left").withColumn("found", rule)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", own).alias("verdict"),
        F.round("mean", DIGITS).alias("bad_rate"),
        F.round("lower", DIGITS).alias("lower_bound"),
    )
