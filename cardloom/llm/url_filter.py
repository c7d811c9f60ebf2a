"""URL filters: written rules first, then the reputation of the host.

Reputation is an empirical-Bayes estimate of the share of bad pages. Labelled pages
are counted by host, registered domain and suffix. At each level the shares of the
units under one parent are taken as beta-binomial: a unit's posterior is its own
counts added to a beta prior whose mean is the parent's posterior mean and
whose strength is estimated by the method of moments over all units of the level.
A host is blocked when even the lower bound of its share stands clearly above the share of
all pages together: a bad host is one that is worse than others, so a corpus with many bad
pages spread evenly blocks nobody. The bound has two parts, what the host's own pages leave
open and how well its prior's mean is known; a prior of many pages does not count as pages
seen. A host with little evidence is judged by its domain, and that by its suffix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import ascii_lower, staged

#: Suffixes of more than one label under which names are registered: a few of thousands;
#: callers with other hosts give a list of their own, say a public suffix file's lines.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
# The bound lies so many standard deviations below the posterior mean.
BOUND = 1.645
# To be blocked a host's odds of a bad page are at least this multiple of those of all pages,
LIFT = 2.0
# and its share is above this one.
MAX_BAD = 0.2
# Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 2.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty without ``://`` or for null."""
    return F.coalesce(
        ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_size(long: Sequence[str]) -> list[tuple[int, list[str]]]:
    """Suffixes by their number of labels, the most labels first."""
    sizes: dict[int, set[str]] = {}
    for name in long:
        name = name.lower().strip(".")
        sizes.setdefault(name.count(".") + 1, set()).add(name)
    return [(k, sorted(sizes[k])) for k in sorted(sizes, reverse=True) if k > 1]


def suffix_of(host: Column, long: Sequence[str] = LONG_SUFFIXES) -> Column:
    """The last label, or the longest suffix of ``long``."""
    tail = lambda k: F.substring_index(host, ".", -k)
    fits = [F.when(tail(k).isin(*names), tail(k)) for k, names in _by_size(long)]
    return F.coalesce(*fits, tail(1))


def domain_of(host: Column, long: Sequence[str] = LONG_SUFFIXES) -> Column:
    """The suffix and one label before it; a host of digits and dots is its own."""
    tail = lambda k: F.substring_index(host, ".", -k)
    fits = [F.when(tail(k).isin(*names), tail(k + 1)) for k, names in _by_size(long)]
    return F.coalesce(F.when(host.rlike(r"^[0-9.:]+$"), host), *fits, tail(2))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, or null. A rule is
    ``host/path``; it fits its host and all subdomains where the path begins with
    the rule's. Of one rule given twice ``block`` wins. The list is the
    caller's and becomes part of the expression."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    given = F.array(
        *[
            F.struct(
                F.lit(len(rule)).alias("size"),
                F.lit(rule).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit(rule[: rule.index("/")].lower()).alias("host"),
                F.lit(rule[rule.index("/") :]).alias("path"),
            )
            for rule, verdict in rules
        ]
    )
    fits = F.filter(
        given,
        lambda r: F.endswith(F.concat(F.lit("."), host), F.concat(F.lit("."), r["host"]))
        & F.startswith(path, r["path"]),
    )
    best = F.array_max(fits)
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _level(
    units: DataFrame, parents: DataFrame | None, key: str, parent: str | None, base: float, pages: float
) -> tuple[DataFrame, float]:
    """Posterior ``mean`` and its variance ``var`` of each unit, and the strength of the prior.

    The strength s follows from how much the shares vary around their parents' means m: for
    n pages Var(x / n) = m (1 - m) (1 + (n - 1) r) / n with r = 1 / (s + 1). The variance
    is that of the unit's beta posterior and, as far as the prior weighs, that of m.
    """
    if parents is None:
        units = units.withColumn("prior", F.lit(base)).withColumn("unsure", F.lit(base * (1 - base) / (pages + 1)))
    else:
        named = parents.select(
            F.col(parents.columns[0]).alias(parent), F.col("mean").alias("prior"), F.col("var").alias("unsure")
        )
        units = units.join(named, parent)
    spread = units.agg(
        F.expr("sum(pages * power(bad / pages - prior, 2))").alias("seen"),
        F.expr("sum(prior * (1 - prior))").alias("even"),
        F.expr("sum(prior * (1 - prior) * (pages - 1))").alias("more"),
    ).first()
    strength = STRONGEST
    if spread["more"] and spread["seen"] > spread["even"]:
        strength = spread["more"] / (spread["seen"] - spread["even"]) - 1
    strength = float(max(WEAKEST, min(STRONGEST, strength)))
    s = F.lit(strength)
    out = units.withColumn("mean", (F.col("bad") + s * F.col("prior")) / (F.col("pages") + s))
    own = F.col("mean") * (1 - F.col("mean")) / (F.col("pages") + s + 1)
    told = s / (F.col("pages") + s)
    return out.select(key, "mean", (own + told * told * F.col("unsure")).alias("var")), strength


def reputation(
    labelled: DataFrame, hosts: DataFrame, long: Sequence[str] = LONG_SUFFIXES
) -> DataFrame:
    """``host, mean, var, lower, base`` for every row of ``hosts(host)``.

    ``labelled(host, bad)`` has one row per labelled page. A host without labelled pages has
    its nearest parent's mean, and the variance of a new unit of every level in between.
    ``base`` is the share of bad pages over all. Rows with a null ``bad`` or host are not
    counted; without any label nothing is known: mean one half, lower bound 0, ``base`` null.
    ``long`` lists the suffixes of more than one label.
    """
    counted = staged(
        labelled.dropna()
        .groupBy("host")
        .agg(F.sum("bad").cast("double").alias("bad"), F.count(F.lit(1)).cast("double").alias("pages"))
        .withColumn("domain", domain_of(F.col("host"), long))
        .withColumn("suffix", suffix_of(F.col("host"), long)),
        "host_counts",
    )
    total = counted.agg(F.sum("bad").alias("bad"), F.sum("pages").alias("pages")).first()
    if not total["pages"]:
        half, none = F.lit(0.5), F.lit(None).cast("double")
        return hosts.select("host", half.alias("mean"), none.alias("var"), F.lit(0.0).alias("lower"), none.alias("base"))
    base, pages = (total["bad"] + 0.5) / (total["pages"] + 1), total["pages"]
    sums = lambda *keys: counted.groupBy(*keys).agg(
        F.sum("bad").alias("bad"), F.sum("pages").alias("pages")
    )
    suffixes, s1 = _level(sums("suffix"), None, "suffix", None, base, pages)
    suffixes = staged(suffixes, "suffixes")
    domains, s2 = _level(sums("domain", "suffix"), suffixes, "domain", "suffix", base, pages)
    domains = staged(domains, "domains")
    known, s3 = _level(counted, domains, "host", "domain", base, pages)
    known = staged(known, "hosts")
    named = lambda df, name: df.select(
        F.col(df.columns[0]).alias(name),
        F.col("mean").alias(f"{name}_mean"),
        F.col("var").alias(f"{name}_var"),
    )
    out = (
        hosts.withColumn("domain", domain_of(F.col("host"), long))
        .withColumn("suffix", suffix_of(F.col("host"), long))
        .join(known, "host", "left")
        .join(named(domains, "domain"), "domain", "left")
        .join(named(suffixes, "suffix"), "suffix", "left")
    )
    mean = F.coalesce("mean", "domain_mean", "suffix_mean", F.lit(base))
    # A new unit's share varies around its parent's like that of the units seen.
    fresh = lambda *strengths: mean * (1 - mean) * sum(1 / (s + 1) for s in strengths)
    var = F.coalesce(
        "var",
        F.col("domain_var") + fresh(s3),
        F.col("suffix_var") + fresh(s3, s2),
        fresh(s3, s2, s1) + base * (1 - base) / (pages + 1),
    )
    out = out.select("host", mean.alias("mean"), var.alias("var"))
    lower = F.greatest(F.lit(0.0), F.col("mean") - F.lit(BOUND) * F.sqrt("var"))
    return out.withColumn("lower", lower).withColumn("base", F.lit(base))


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    max_bad: float = MAX_BAD,
    id_col: str = "page_id",
    url_col: str = "url",
    long: Sequence[str] = LONG_SUFFIXES,
    lift: float = LIFT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, lower`` for every row of ``pages``.

    The verdict is the rule's, else ``block`` where the lower bound of the host's
    share of bad pages is above ``max_bad`` and its odds above ``lift`` times the odds over
    all pages. Without labels, and where hosts differ no more than chance would have
    them, nothing but the rules blocks. ``labelled(host, bad)`` and ``long`` as in
    ``reputation``. A url that is null or has no ``://`` has an empty host and
    path and is judged like a host of that name. Null ids and rows that
    repeat are kept, other columns not read. A host with very many pages meets
    its one verdict in a join whose large partitions Spark splits.
    """
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    known = staged(reputation(labelled, rows.select("host").distinct(), long), "reputation")
    return (
        rows.join(known, "host")
        .withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.expr(
                f"coalesce(found.verdict, case when lower > {max_bad}D"
                f" and lower * (1 - base) > {lift}D * base * (1 - lower) then 'block' else 'allow' end)"
            ).alias("verdict"),
            "lower",
        )
    )
