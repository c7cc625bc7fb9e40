"""URL filter: allow and block rules, then empirical-Bayes host reputation.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end (A-Z lower-cased), the path what follows up to ``?``, ``#`` or the end.
A rule names a host (and all its subdomains) and the start of a path; of the
rules that fit, the longest decides (equal lengths: the greater text).

Where no rule fits, the host's reputation does. Labelled page outcomes (bad or
not) are counted per host, registered domain and suffix. Each level's rate
gets a beta prior whose mean is the posterior mean one level up (the suffixes'
prior mean is the overall rate) and whose strength is estimated by moments
from the spread of that level's groups round their prior means. A page is
blocked when the lower bound ``mean - z * sd`` of its host's beta posterior is
over ``max_bad``. A host without labels has its domain's posterior mean and
the prior's spread, and so on up.

All of it is DataFrame code over page urls and outcome counts; hosts are joined,
never collected. Null urls and urls without ``://`` have empty host and path and
the reputation of the empty host. Pages without a (non-null) outcome don't
count; several outcomes of one page count each. Repeated rows are counted and judged as they come.
Columns of the input are kept; one with the name of an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
MAX_BAD = 0.25
Z = 1.645
ADDED = ("host", "path", "rule", "verdict", "bad_rate", "bad_bound")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(size, rule, verdict) of the deciding rule, or null."""
    fits = []
    for verdict, rule in rules:
        name, _, start = rule.partition("/")
        fit = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        fits.append(
            F.when(fit, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        )
    if not fits:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits))


def groups_of(host: Column, long_suffixes=LONG_SUFFIXES) -> list[Column]:
    """suffix and registered domain of a host."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    if long_suffixes:
        long_ = two.isin(*long_suffixes)
        return [
            F.when(long_, two).otherwise(F.substring_index(name, ".", -1)).alias("suffix"),
            F.when(long_, F.substring_index(name, ".", -3)).otherwise(two).alias("domain"),
        ]
    return [F.substring_index(name, ".", -1).alias("suffix"), two.alias("domain")]


def _shrink(groups: DataFrame, keys: list[str], mean: str | Column) -> DataFrame:
    """groups (keys.., n, bad, ``mean`` = prior mean) with alpha and beta of the
    posterior. The level's strength: 1 / rho - 1, where rho is the excess of the
    squared deviations over binomial ones, for each pair of trials, kept in
    [0.0001, 0.5]."""
    m, n, k = (F.col(mean) if isinstance(mean, str) else mean), F.col("n"), F.col("bad")
    rho = groups.agg(
        F.sum((k - n * m) * (k - n * m) - n * m * (1 - m)).alias("excess"), F.sum(n * (n - 1) * m * (1 - m)).alias("pairs")
    ).select(
        F.least(
            F.lit(0.5), F.greatest(F.lit(0.0001), F.when(F.col("pairs") > 0, F.col("excess") / F.col("pairs")).otherwise(0.0001))
        )
    ).scalar()
    strength = 1 / rho - 1
    return groups.select(
        *keys, (strength * m + k).alias("alpha"), (strength * (1 - m) + n - k).alias("beta")
    )


def reputation(outcomes: DataFrame, hosts: DataFrame, limit: float = MAX_BAD) -> DataFrame:
    """``outcomes`` (host, suffix, domain, n, bad) per labelled host, ``hosts``
    (host, suffix, domain) to judge -> (host, bad_rate, bad_sd). The overall rate counts
    one page more, at the limit, so that without outcomes no host is over it."""
    # labelled or not, each host belongs to its groups; unlabelled ones have n = 0
    known = hosts.join(outcomes.select("host", "n", "bad"), "host", "left").fillna(0, ["n", "bad"])
    # each level is written: it is read several times by the next, and nested plans would grow level by level
    known = stored(known, "hosts")
    overall = known.agg((F.coalesce(F.sum("bad"), F.lit(0)) + limit) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).scalar()
    posterior = lambda a, b: (F.col(a) / (F.col(a) + F.col(b)))
    suffixes = known.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = stored(_shrink(suffixes, ["suffix"], overall), "suffixes")
    domains = known.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = domains.join(suffixes.select("suffix", posterior("alpha", "beta").alias("prior")), "suffix")
    domains = stored(_shrink(domains, ["domain"], "prior"), "domains")
    single = stored(known.join(domains.select("domain", posterior("alpha", "beta").alias("prior")), "domain"), "priors")
    single = _shrink(single, ["host"], "prior")
    total = F.col("alpha") + F.col("beta")
    return single.select(
        "host",
        posterior("alpha", "beta").alias("bad_rate"),
        F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1))).alias("bad_sd"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    long_suffixes=LONG_SUFFIXES,
    max_bad: float = MAX_BAD,
    z: float = Z,
) -> DataFrame:
    """``pages`` (any columns, ``url`` among them) with host, path, rule,
    verdict, bad_rate and bad_bound. ``outcomes`` has url and bad (boolean), a row per labelled page."""
    rest = [c for c in pages.columns if c not in ADDED]
    suffix, domain = groups_of(F.col("host"), long_suffixes)
    judged = pages.select(*rest, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = judged.select("host").distinct()
    labelled = (
        outcomes.filter("bad is not null")
        .groupBy(host_of(F.col("url")).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    )
    hosts = hosts.unionByName(labelled.select("host")).distinct().select("host", suffix, domain)
    rates = reputation(labelled, hosts, max_bad)
    bound = F.col("bad_rate") - z * F.col("bad_sd")
    own = F.when(bound > max_bad, "block").otherwise("allow")
    return (
        judged.join(rates, "host")
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .select(
            *rest,
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), own).alias("verdict"),
            "bad_rate",
            bound.alias("bad_bound"),
        )
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes (url, bad) of ``pages`` whose document is labelled. A page's
    document is the number that is its path's second part; it is bad if the
    document's quality is 0 or it is toxic."""
    doc = F.regexp_extract(path_of(F.col("url")), r"^/[^/]*/([0-9]{1,18})(?:[^0-9]|$)", 1)
    named = pages.select("url", F.when(doc != "", doc).cast("long").alias("doc_id")).filter("doc_id is not null")
    judged = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return named.join(judged, "doc_id").select("url", "bad")


def op10_url_reputation(spark, sf_dir: str) -> DataFrame:
    """Contract query over every row of ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    outcomes = page_outcomes(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")
