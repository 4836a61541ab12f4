"""URL filters: explicit rules first, then empirical-Bayes host reputation.

Labelled page outcomes are counted for each host, and shrunk through beta-binomial priors: a suffix is shrunk to the rate
of all pages, a registered domain to its suffix, a host to its registered domain. How strongly is itself learned at each
level: the method of moments gives the correlation of outcomes within a group beyond that of its parent. A parent's rate
is itself uncertain, and that is carried: the prior of a group has the variance between groups and that of its parent's
posterior. A host is blocked if the lower bound of its rate, the quantile ``TAIL`` of its beta posterior, is above
``lift`` times the rate of all labelled pages. So what is blocked follows from the outcomes, and few outcomes block
nothing unless those of their parents do.

Reputation is that of a site, the host without user, port and trailing dots; an address of numbers is a domain of its
own. Suffixes are the last labels of hosts, or what a list of public suffixes says.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.llm.common import table, written

#: (verdict, host and path prefix); a rule fits its host and all subdomains, and the longest fitting one wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Without a list of suffixes these labels under a country code are suffixes, under which anyone can register.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "ne", "net", "or", "org")
#: How much worse than all pages a blocked host is, and the share of the posterior below its bound.
LIFT, TAIL = 1.5, 0.05
#: Halvings that find a quantile, and terms of the continued fraction at most.
HALVINGS, TERMS = 60, 20_000

#: Correlation within a group is kept between these, so that a prior is worth from 0.25 to 999 outcomes.
LEAST_RHO, MOST_RHO = 0.001, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def site_of(host: Column) -> Column:
    """The host without user, port and trailing dots."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.*(:[0-9]*)?$", "")


def is_address(site: Column) -> Column:
    return site.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*)$")


def suffix_of(site: Column) -> Column:
    """The last label, or two of them: a known second-level label under a country code. Addresses have none."""
    last, pair = F.substring_index(site, ".", -1), F.substring_index(site, ".", -2)
    two = pair.rlike(rf"^({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$")
    return F.when(is_address(site), "").when(two, pair).otherwise(last)


def suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a list of public suffixes, one in each line: a suffix, ``*.`` before one, or ``!`` before an exception."""
    line = F.lower(F.regexp_extract("value", r"^\s*(\S*)", 1))
    return spark.read.text(path).select(line.alias("rule")).filter("rule <> '' AND NOT startswith(rule, '//')").distinct()


def with_suffixes(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds suffix to distinct sites, by rules: an exception's suffix is what follows its first label, else the longest rule wins.

    A wildcard stands for one label. A site that no rule fits has its last label; an address has none. Tails of a site with
    more labels than the longest rule fit none and aren't tried.
    """
    most = rules.agg(F.max(F.size(F.split("rule", r"\."))).alias("n")).first().n or 1
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(F.split("site", r"\.")), F.lit(most + 1))), lambda n: F.call_function("substring_index", F.col("site"), F.lit("."), -n))
    parent = F.regexp_replace("tail", r"^[^.]*\.?", "")
    way = lambda key, suffix, first: F.struct(key.alias("rule"), suffix.alias("suffix"), F.lit(first).alias("first"))
    ways = F.array(way(F.col("tail"), F.col("tail"), 0), way(F.concat(F.lit("*."), parent), F.col("tail"), 0), way(F.concat(F.lit("!"), F.col("tail")), parent, 1))
    tried = sites.filter(~is_address(F.col("site"))).select("site", F.explode(tails).alias("tail")).select("site", F.inline(ways))
    best = F.max(F.struct("first", F.length("suffix").alias("n"), "suffix"))
    found = tried.join(rules.select("rule").distinct(), "rule").groupBy("site").agg(best["suffix"].alias("suffix"))
    last = F.when(is_address(F.col("site")), "").otherwise(F.substring_index("site", ".", -1))
    return sites.join(found, "site", "left").withColumn("suffix", F.coalesce("suffix", last))


def domain_of(site: Column, suffix: Column) -> Column:
    """The suffix and one label more; an address is a domain as it is, and so is a site that is a suffix."""
    labels, n = F.split(site, r"\."), F.size(F.split(suffix, r"\.")) + 1
    return F.when(is_address(site) | (F.size(labels) <= n), site).otherwise(F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null if none fits. The list is a parameter of some dozens of rules."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _rho(df: DataFrame, mean: str) -> float:
    """Method of moments for the correlation within groups that have n outcomes, bad of them, and an expected rate."""
    m = F.col(mean)
    one = df.agg(
        F.sum((F.col("bad") - F.col("n") * m) ** 2 - F.col("n") * m * (1 - m)).alias("over"),
        F.sum(m * (1 - m) * F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    return min(MOST_RHO, max(LEAST_RHO, one.over / one.pairs)) if one.pairs else MOST_RHO


def _shrunk(df: DataFrame, parent: str, name: str) -> DataFrame:
    """Adds the posterior's mean, size (sum of its parameters) and variance; the parent has a mean and a variance."""
    m, v, k = F.col(parent), F.col(f"{parent}_var"), 1 / _rho(df, parent) - 1
    spread = (m * (1 - m) - v) / (k + 1) + v
    prior = F.when(spread > 0, m * (1 - m) / spread - 1).otherwise(F.lit(k))
    out = df.withColumn("prior", prior).withColumn(name, (F.col("bad") + F.col("prior") * m) / (F.col("n") + F.col("prior")))
    out = out.withColumn(f"{name}_size", F.col("n") + F.col("prior")).drop("prior")
    return out.withColumn(f"{name}_var", F.col(name) * (1 - F.col(name)) / (F.col(f"{name}_size") + 1))


def beta_share(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of a beta distribution below x (between 0 and 1), by the continued fraction of the incomplete beta function."""
    turned = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    logs = np.array([lgamma(p + q) - lgamma(p) - lgamma(q) for p, q in zip(a, b, strict=True)])
    with np.errstate(divide="ignore"):
        front = np.exp(logs + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    f = d.copy()
    for k in range(1, TERMS):
        for term in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            f *= c * d
        if np.all(np.abs(c * d - 1) < 1e-15):
            break
    return np.where(turned, 1 - front * f, front * f)


def beta_quantile(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """By halving, to within 1e-18; 0 where a is 0 and 1 where b is."""
    low, high = np.zeros_like(a), np.ones_like(a)
    inner = (a > 0) & (b > 0)
    p, q = np.where(inner, a, 1.0), np.where(inner, b, 1.0)
    for _ in range(HALVINGS):
        mid = (low + high) / 2
        less = beta_share(mid, p, q) < share
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    return np.where(inner, (low + high) / 2, np.where(a > 0, 1.0, 0.0))


def lower_bound(mean: Column, size: Column) -> Column:
    """The quantile TAIL of the beta distribution with this mean, its parameters adding up to size."""

    @F.pandas_udf("double")
    def quantile(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for m, n in parts:
            a, b = (m * n).to_numpy(float), ((1 - m) * n).to_numpy(float)
            known = ~(np.isnan(a) | np.isnan(b))
            out = np.full(len(a), np.nan)
            out[known] = beta_quantile(a[known], b[known], TAIL)
            yield pd.Series(out)

    return quantile(mean, size)


def site_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """One row for each non-empty site of pages (page_id, site): n, bad, bad_mean, bad_lower and the rate of all pages.

    outcomes has page_id and bad (0 or 1). Several outcomes of a page count as the worst of them; null outcomes and those
    of unknown pages count for nothing. Sites without outcomes get their domain's prior. Without any outcome the rate is 0.
    """
    worst = outcomes.filter("bad IS NOT NULL AND page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counts = pages.filter("site <> ''").join(worst, "page_id", "left").groupBy("site").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    named = counts.withColumn("suffix", suffix_of(F.col("site"))) if suffixes is None else with_suffixes(counts, suffixes)
    sites = written(named.withColumn("domain", domain_of(F.col("site"), F.col("suffix"))), "sites")
    total = sites.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = float(total.bad / total.n) if total.n else 0.0
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    # the rate of all pages counts as known
    of_suffix = _shrunk(sites.groupBy("suffix").agg(*sums).withColumns({"of_all": F.lit(rate), "of_all_var": F.lit(0.0)}), "of_all", "of_suffix")
    domains = sites.groupBy("suffix", "domain").agg(*sums).join(of_suffix.select("suffix", "of_suffix", "of_suffix_var"), "suffix")
    domains = _shrunk(domains, "of_suffix", "of_domain").select("domain", "of_domain", "of_domain_var")
    out = _shrunk(sites.join(domains, "domain"), "of_domain", "bad_mean")
    return out.select("site", "domain", "n", "bad", "bad_mean", lower_bound(F.col("bad_mean"), F.col("bad_mean_size")).alias("bad_lower"), F.lit(rate).alias("rate"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, lift: float = LIFT, suffixes: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule, verdict, bad_mean and bad_lower to pages (page_id, url, any others).

    The verdict is that of the longest fitting rule, else block if the site's bad_lower is above lift times the rate of all
    labelled pages, else allow. A null url or one without ``://`` has empty host and path, no reputation and the verdict
    allow. Repeated rows stay repeated, and each counts for the rates. Columns of pages with the added names are replaced;
    others, whatever their names are, pass through. A site with a third of all pages is split by the join's skew handling:
    its side of the reputation is one row. suffixes are rules (``suffix_rules``); without, a suffix is a host's last label.
    """
    added = ["host", "path", "rule", "verdict", "bad_mean", "bad_lower"]
    names = [c for c in pages.columns if c not in added]
    kept = [f"c{k}" for k in range(len(names))]  # so that no other column's name clashes
    split = pages.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept, strict=True)), "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    split = split.withColumn("site", site_of(F.col("host")))
    known = written(site_reputation(split.select("page_id", "site"), outcomes, suffixes).select("site", "bad_mean", "bad_lower", "rate"), "reputation")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_lower") > lift * F.col("rate"), F.lit("block")).otherwise(F.lit("allow"))
    out = split.join(known, "site", "left").withColumns({"rule": rule, "verdict": F.coalesce(verdict, method)})
    return out.select(*(F.col(k).alias(c) for c, k in zip(names, kept, strict=True)), *added)


def labelled_outcomes(labels: DataFrame) -> DataFrame:
    """A page's outcome is the label with its number: bad if toxic or of low quality, null if neither is known."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge_urls(pages, labelled_outcomes(table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("bad_mean", 6).alias("bad_mean"))


def _level(name: str, rows: str, parent: str, out: str) -> str:
    rho = f"least({MOST_RHO}, greatest({LEAST_RHO}, sum((bad - n * {parent}) ** 2 - n * {parent} * (1 - {parent})) / nullif(sum({parent} * (1 - {parent}) * n * (n - 1)), 0)))"
    return f"""{name}_rho AS (SELECT coalesce({rho}, {MOST_RHO}) AS rho FROM ({rows})),
{name}_prior AS (SELECT r.*, rho, ({parent} * (1 - {parent}) - {parent}_var) * rho + {parent}_var AS spread FROM ({rows}) r, {name}_rho),
{name}_size AS (SELECT *, CASE WHEN spread > 0 THEN {parent} * (1 - {parent}) / spread ELSE 1 / rho END - 1 AS k FROM {name}_prior),
{name}_mean AS (SELECT *, (bad + k * {parent}) / (n + k) AS {out} FROM {name}_size),
{name} AS (SELECT *, {out} * (1 - {out}) / (n + k + 1) AS {out}_var FROM {name}_mean)"""


_FITS = "\n".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{v}|{r}'" for v, r in sorted(RULES, key=lambda x: -len(x[1])))

ORACLE = rf"""
WITH q AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), '\.*(:[0-9]*)?$', '') AS site FROM q),
worst AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
named AS (
  SELECT site, string_split(site, '.') AS l, regexp_matches(site, '^([0-9]+(\.[0-9]+){{3}}|\[.*)$') AS numbers,
         count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
  FROM p LEFT JOIN worst ON page_id = doc_id WHERE site <> '' GROUP BY 1),
paired AS (
  SELECT *, len(l) >= 2 AND length(l[-1]) = 2 AND regexp_matches(l[-1], '^[a-z]+$')
            AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'ne', 'net', 'or', 'org') AS two FROM named),
hosts AS (
  SELECT site AS host, n, bad, CASE WHEN numbers THEN '' WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
         CASE WHEN numbers THEN site WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM paired),
rate AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS of_all, 0.0 AS of_all_var FROM hosts),
{_level('s', 'SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(of_all) AS of_all, any_value(of_all_var) AS of_all_var FROM hosts, rate GROUP BY 1', 'of_all', 'of_suffix')},
{_level('d', 'SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value(of_suffix) AS of_suffix, any_value(of_suffix_var) AS of_suffix_var FROM hosts h JOIN s ON h.suffix = s.suffix GROUP BY 1, 2', 'of_suffix', 'of_domain')},
{_level('h', 'SELECT hosts.*, of_domain, of_domain_var FROM hosts JOIN d ON hosts.domain = d.domain', 'of_domain', 'bad_mean')},
beta AS (
  SELECT host, bad_mean, 1.5 * of_all AS x, bad_mean * (n + k) AS a, (1 - bad_mean) * (n + k) AS b, ln(a / b) AS mode, ln(x / (1 - x)) AS t
  FROM h, rate WHERE bad_mean > 0 AND bad_mean < 1 AND 1.5 * of_all < 1),
-- the density of the log odds, by Simpson's rule on both sides of those of the limit
side AS (
  SELECT host, a, b, mode, false AS above, least(t, mode) - 45 / a - 5 AS lo, t AS hi FROM beta
  UNION ALL SELECT host, a, b, mode, true, t, greatest(t, mode) + 45 / b + 5 FROM beta),
point AS (SELECT *, lo + (hi - lo) * i / 4000 AS t FROM side, (SELECT unnest(range(4001)) AS i)),
area AS (
  SELECT host, above, sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * (hi - lo)
         * exp(-a * (ln(1 + exp(-abs(t))) + greatest(-t, 0) - ln(1 + exp(-mode))) - b * (ln(1 + exp(-abs(t))) + greatest(t, 0) - ln(1 + exp(mode))))) AS area
  FROM point GROUP BY 1, 2),
share AS (SELECT host, sum(area) FILTER (NOT above) / sum(area) AS below FROM area GROUP BY 1),
known AS (SELECT h.host, bad_mean, coalesce(below < 0.05, bad_mean = 1 AND 1.5 * of_all < 1) AS bad FROM h CROSS JOIN rate LEFT JOIN share ON share.host = h.host),
fit AS (SELECT *, CASE {_FITS} END AS fits FROM p)
SELECT page_id, fit.host, path, string_split(fits, '|')[2] AS rule,
       coalesce(string_split(fits, '|')[1], CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict,
       round(bad_mean, 6) AS bad_mean
FROM fit LEFT JOIN known ON fit.site = known.host
"""
