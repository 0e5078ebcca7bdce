"""URL filters: host rules, and for the rest an empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host.  A beta-binomial prior for the share
of bad pages is fitted for each suffix from its registered domains, for each
registered domain from its hosts, and for all suffixes together, by the method of
moments; each level's counts are shrunk towards the level above.  A host is
turned away when the lower bound of its posterior (mean minus z standard
deviations) is above the limit, so few pages never condemn a host.
A host without labelled pages has the prior of its registered domain, else of its
suffix, else of all suffixes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countloom.llm.store import stored

#: Fixed values: (host, path prefix, verdict) of the rules in force.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Suffixes of two labels under which different registrants stand; others are the last label.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "edu.au", "co.nz", "co.jp", "ne.jp", "or.jp", "ac.jp",
    "co.kr", "co.in", "co.za", "com.br", "com.mx", "com.ar", "com.cn", "com.tw", "com.hk", "com.sg", "com.tr",
    "github.io", "gitlab.io", "blogspot.com", "wordpress.com", "pages.dev", "netlify.app", "vercel.app", "herokuapp.com",
)

#: Share of a prior's weight that stands for an unseen host where one member says nothing of the spread among members.
LONE = 0.2


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) columns; both empty for null urls and urls without ``://``.

    The host runs to the next slash, question mark, hash or the end, A-Z in lower
    case; the path goes on from there to a question mark, hash or the end.
    """
    whole = F.coalesce(url, F.lit(""))
    found = F.instr(whole, "://")
    rest = F.when(found > 0, F.substr(whole, found + 3)).otherwise(F.lit(""))
    head = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    lower = F.translate(head, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return lower, path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits the host or a parent of it and starts the path; null if none."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        name = F.when(fits, f"{site}{start}").otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def levels(host: Column, suffixes: Sequence[str] = SUFFIXES) -> dict[str, Column]:
    """Suffix (one of ``suffixes``, else the last label) and registered domain (one label more; the host itself if it has none).

    User names and ports in a host are not part of either.
    """
    name = F.regexp_replace(F.substring_index(host, "@", -1), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    wide = two.isin(*suffixes)
    return {
        "suffix": F.when(wide, two).otherwise(F.substring_index(name, ".", -1)),
        "domain": F.when(wide, F.substring_index(name, ".", -3)).otherwise(two),
    }


def _prior(counts: DataFrame, by: Sequence[str], above: str, out: str) -> DataFrame:
    """Beta prior (a, b) per group of ``by`` from the members' (bad, n), around the shrunken mean ``above``.

    The concentration comes from the spread of the members' shares beyond what
    chance explains; it is kept between 1 and 200, and is 10 for groups of one.
    """
    mean = F.col(above)
    members = F.count(F.lit(1))
    n, n2 = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2))
    stats = counts.groupBy(*by, mean.alias("m_")).agg(members.alias("k_"), n.alias("n_"), n2.alias("n2_"), spread.alias("s_"))
    chance = F.col("m_") * (1 - F.col("m_"))
    # E[sum n (p - m)^2] = chance * (k + rho * (n - k)); solve for rho = 1 / (concentration + 1).
    rho = (F.col("s_") / F.greatest(chance, F.lit(1e-9)) - F.col("k_")) / F.greatest(F.col("n_") - F.col("k_"), F.lit(1.0))
    rho = F.greatest(F.lit(1.0 / 201.0), F.least(F.lit(0.5), rho))
    strength = F.when(F.col("k_") > 1, 1.0 / rho - 1.0).otherwise(F.lit(10.0))
    return stats.select(
        *by, (F.col("m_") * strength).alias(f"{out}_a"), ((1 - F.col("m_")) * strength).alias(f"{out}_b"),
        F.when(F.col("k_") > 1, 1.0).otherwise(LONE).alias(f"{out}_w"),
    )


def priors(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Beta distributions of the share of bad pages: ``hosts`` (posterior a, b), ``domains``, ``suffixes`` and ``top`` (priors of their members).

    Null hosts and outcomes count nothing.  Hosts are counted map-side first, so a
    hot host is one row per task; every later level only sees one row per host.
    ``top`` is one row, also without any outcome.
    """
    hosts = (
        outcomes.where(F.col("host").isNotNull() & F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    )
    hosts = stored(hosts.withColumns(levels(F.col("host"))), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    # One row: the share over everything, smoothed so that it is never 0 or 1.
    overall = hosts.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1.0)).alias("all_"))
    suffixes = suffixes.crossJoin(F.broadcast(overall))
    found = _prior(suffixes.withColumn("one_", F.lit(1)), ["one_"], "all_", "top").drop("one_")
    top = overall.join(F.broadcast(found), F.lit(True), "left").select(
        F.coalesce("top_a", F.col("all_") * 10.0).alias("top_a"), F.coalesce("top_b", (1.0 - F.col("all_")) * 10.0).alias("top_b"),
        F.coalesce("top_w", F.lit(LONE)).alias("top_w"),
    )
    shrunk = suffixes.crossJoin(F.broadcast(top)).select(
        "suffix", ((F.col("bad") + F.col("top_a")) / (F.col("n") + F.col("top_a") + F.col("top_b"))).alias("m_suffix")
    )
    domains = domains.join(shrunk, "suffix")
    suffix_prior = _prior(domains, ["suffix"], "m_suffix", "suffix")
    domains = domains.join(suffix_prior, "suffix").select(
        "suffix", "domain",
        ((F.col("bad") + F.col("suffix_a")) / (F.col("n") + F.col("suffix_a") + F.col("suffix_b"))).alias("m_domain"),
    )
    members = hosts.join(domains, ["suffix", "domain"])
    domain_prior = _prior(members, ["suffix", "domain"], "m_domain", "domain")
    posterior = hosts.join(domain_prior, ["suffix", "domain"]).select(
        "host", (F.col("bad") + F.col("domain_a")).alias("host_a"), (F.col("n") - F.col("bad") + F.col("domain_b")).alias("host_b"), F.lit(1.0).alias("host_w")
    )
    return {"hosts": posterior, "domains": domain_prior.drop("suffix"), "suffixes": suffix_prior, "top": top}


def reputations(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, mean, sd and level for every distinct host asked for; ``level`` names where its distribution comes from.

    A host of ``outcomes`` has its own posterior (``host``); others have the prior
    of the members of their registered domain, suffix or of all, at a fifth of its
    weight (``LONE``) where there is but one member.  A null or empty host has no row.
    """
    known = priors(outcomes)
    asked = hosts.select("host").where(F.col("host") != "").distinct().withColumns(levels(F.col("host")))
    out = (
        asked.join(known["hosts"], "host", "left")
        .join(known["domains"], "domain", "left")
        .join(known["suffixes"], "suffix", "left")
        .crossJoin(F.broadcast(known["top"]))  # a single row
    )
    steps = ("host", "domain", "suffix", "top")
    level = F.coalesce(*[F.when(F.col(f"{s}_a").isNotNull(), F.lit(s)) for s in steps])
    a, b = (F.coalesce(*[F.col(f"{s}_{side}") * F.col(f"{s}_w") for s in steps]) for side in "ab")
    out = out.select("host", level.alias("level"), a.alias("a_"), b.alias("b_"))
    total = F.col("a_") + F.col("b_")
    sd = F.sqrt(F.col("a_") * F.col("b_") / (total * total * (total + 1.0)))
    return out.select("host", "level", (F.col("a_") / total).alias("mean"), sd.alias("sd"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bad: float = 0.25,
    z: float = 1.645,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and mean, sd, bound and level of its host's reputation.

    A rule's verdict stands; without a rule the page is blocked when its host's
    posterior bound is above ``max_bad``.  Hosts without labelled pages are judged
    by the prior of their domain, suffix or of all; pages without a host are
    allowed.  Without outcomes everything without a rule is allowed, as the bound
    of the widest prior is low.  Repeated rows each get a row, an empty table none;
    no other column of ``pages`` is read.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(id_col).alias("id_"), host.alias("host"), path.alias("path"))
    name, says = rule_for(F.col("host"), F.col("path"), rules)
    known = reputations(parts, outcomes).select(F.col("host").alias("host_"), "mean", "sd", "level")
    joined = parts.join(known, F.col("host") == F.col("host_"), "left")
    bound = F.col("mean") - z * F.col("sd")
    own = F.when(F.coalesce(bound, F.lit(0.0)) > max_bad, "block").otherwise("allow")
    return joined.select(
        F.col("id_").alias(id_col), "host", "path", name.alias("rule"), F.coalesce(says, own).alias("verdict"),
        F.round("mean", 9).alias("bad_mean"), F.round("sd", 9).alias("bad_sd"), F.round(bound, 9).alias("bad_bound"),
        F.col("level").alias("bad_level"),
    )
