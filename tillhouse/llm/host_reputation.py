"""URL filters: rules first, then the reputation of hosts by empirical Bayes.

Outcomes of labelled pages (bad or not) are counted per host. A host with few
labelled pages says little, so its rate is shrunk towards that of its registered
domain, the domain's towards its suffix, and the suffix's towards all pages. At each level
the children's rates are taken as draws from a beta distribution around the parent; its
strength is fitted by moments. A host is blocked when even the lower bound of its
posterior bad rate is above the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import to_lower_ascii

#: Rules as (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Bounds of a fitted prior strength, in labelled pages.
WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; empty without one."""
    rest = _after_scheme(url)
    return to_lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """`struct(rule, verdict)` of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def domain_of(host: Column) -> Column:
    """The registered domain, taken as the last two labels."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(children: DataFrame, parent: list[str]) -> DataFrame:
    """Per parent: pages `n`, bad pages `bad`, and the prior strength its children show.

    By moments: with children's sizes n and mean rate m, the spread beyond binomial
    noise gives 1 / (strength + 1). Too little spread gives the strongest prior.
    """
    sums = children.groupBy(*parent).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("spread"),
    )
    n, k = F.col("n"), F.col("k")
    rate = F.col("bad") / n
    noise = rate * (1 - rate)
    # Expected squares about the mean are noise * (k - 1 + rho * (n - nn / n - (k - 1))).
    about = F.col("spread") - n * rate * rate
    rho = F.when((noise > 0) & (k > 1) & (n > F.col("nn") / n + k - 1), (about / noise - (k - 1)) / (n - F.col("nn") / n - (k - 1)))
    strength = F.when(rho.isNull() | (rho <= 0), F.lit(STRONGEST)).otherwise(
        F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), 1 / rho - 1))
    )
    return sums.select(*parent, "n", "bad", strength.alias("strength"))


def reputations(outcomes: DataFrame, z: float = 1.645, min_rate: float = 0.5, prior: float = 1.0, hosts: DataFrame | None = None) -> DataFrame:
    """`host, n, bad, posterior, bound` from rows of `host, bad` (boolean, null not counted).

    `bound` is the lower normal bound of the beta posterior at `z` deviations. `hosts` (a
    column `host`) are told too: without labelled pages they have the prior of their domain, else of their
    suffix, else of all. `prior` pages at `min_rate` stand above the suffixes, so few labelled pages
    give no certainty; without any, no host has a reputation. An empty host has none.
    """
    counted = outcomes.where(F.col("bad").isNotNull() & F.col("host").isNotNull())
    own = counted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    placed = own.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = _strength(placed, ["suffix", "domain"])
    suffixes = _strength(domains.select("suffix", "n", "bad"), ["suffix"])
    root = _strength(suffixes.select(F.lit(1).alias("all"), "n", "bad"), ["all"])
    top = root.select(((F.col("bad") + prior * min_rate) / (F.col("n") + prior)).alias("m0"), F.col("strength").alias("s0"))
    # One row, whose size does not grow: it is broadcast.
    by_suffix = suffixes.join(F.broadcast(top), how="left").select(
        "suffix", F.col("strength").alias("s1"), ((F.col("bad") + F.col("s0") * F.col("m0")) / (F.col("n") + F.col("s0"))).alias("m1")
    )
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", F.col("strength").alias("s2"), ((F.col("bad") + F.col("s1") * F.col("m1")) / (F.col("n") + F.col("s1"))).alias("m2")
    )
    told = own
    if hosts is not None:
        none = hosts.where(F.col("host") != "").select("host").distinct().select("host", F.lit(0).alias("n"), F.lit(0).alias("bad"))
        told = own.unionByName(none).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    told = told.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    told = told.join(by_domain, "domain", "left").join(by_suffix, "suffix", "left").join(F.broadcast(top))
    strength, rate = F.coalesce("s2", "s1", "s0"), F.coalesce("m2", "m1", "m0")
    a, b = F.col("bad") + strength * rate, F.col("n") - F.col("bad") + strength * (1 - rate)
    mean, size = a / (a + b), a + b
    bound = mean - z * F.sqrt(mean * (1 - mean) / (size + 1))
    return told.select("host", "n", "bad", mean.alias("posterior"), bound.alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = 1.645, min_rate: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """`page_id, host, path, rule, verdict, bound` per page.

    The longest rule that fits decides, else the host's reputation: block when its
    bound is over `min_rate`, allow otherwise. Hosts without labelled pages have the reputation of
    their domain, suffix or of all; an empty host, or any host where no page is labelled, is allowed. A
    null url, or one without `://`, has an empty host and path. Repeated rows stay;
    other columns are not read; empty tables give an empty result or no reputations.
    """
    own = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = own.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    known = reputations(outcomes, z, min_rate, hosts=own).select("host", "bound")
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("bound") > min_rate, F.lit("block")).otherwise(F.lit("allow")))
    return found.join(known, "host", "left").select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "bound")
