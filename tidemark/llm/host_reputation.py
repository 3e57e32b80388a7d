"""URL filter: fixed rules first, then host reputation by empirical Bayes.

Labelled pages say of a host how often its pages are bad. Rates are shrunk down the tree of names:
the suffix toward all pages, the registered domain toward its suffix, the host toward its domain.
Each step is a beta-binomial: the prior has the parent's mean and a strength taken by the method
of moments from how much the groups of that level differ beyond chance. A host is blocked if the
lower bound of its posterior rate, ``BOUND`` standard deviations below the mean, is above
``LIMIT``. A host without labelled pages has its domain's mean and the prior's spread.

Everything is DataFrame functions. Counts combine before the shuffle, so a host with most pages
sends one row per task; domains and suffixes are summed from hosts. The driver sees three numbers
per level.

Rows: a null url, or one without ``://``, has an empty host and path and is judged as host "".
Labels without a page, or with both marks null, say nothing; repeated labels of a page count once,
the worse one. Without labels nothing is blocked but by rule. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LIMIT = 0.5
BOUND = 1.645
WEAKEST, STRONGEST = 1e-4, 0.999
"""Bounds of the intra-class correlation from which a prior's strength follows."""

# Second-level names under which country suffixes register; fixed values.
SECOND_LEVEL = ("co", "com", "net", "org", "ac", "gov", "edu")


@dataclass(frozen=True)
class Rule:
    """Fits ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | host.endswith("." + self.host)
        return same & path.startswith(self.path)


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix, by the last labels of the name without its port."""
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    last, second = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    two = (F.length(last) == 2) & F.coalesce(second.isin(*SECOND_LEVEL), F.lit(False))
    of = lambda n: F.array_join(F.slice(labels, -F.least(n, F.size(labels)), n), ".")
    take = F.when(two, F.lit(2)).otherwise(F.lit(1))
    return of(take + 1), of(take)


def by_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: (len(r.text), r.verdict == "block"))
    none = F.lit(None).cast("string")
    text = reduce(lambda out, r: F.when(r.fits(host, path), r.text).otherwise(out), ordered, none)
    verdict = reduce(
        lambda out, r: F.when(r.fits(host, path), r.verdict).otherwise(out), ordered, none
    )
    return text, verdict


def _strength(groups: DataFrame) -> float:
    """Prior strength from rows (n, bad, mean), ``mean`` being the parent's rate."""
    n, p, m = F.col("n"), F.col("bad") / F.col("n"), F.col("mean")
    spread = m * (1 - m)
    sums = (
        groups.where("n > 0")
        .agg(
            F.sum(n * (p - m) * (p - m)).alias("s"),
            F.sum(spread).alias("chance"),
            F.sum((n - 1) * spread).alias("room"),
        )
        .first()
    )
    if not sums.room:
        share = WEAKEST
    else:
        share = (sums.s - sums.chance) / sums.room
    return 1 / min(STRONGEST, max(WEAKEST, share)) - 1


def _shrunk(groups: DataFrame, strength: float) -> Column:
    return (F.lit(strength) * F.col("mean") + F.col("bad")) / (F.lit(strength) + F.col("n"))


def reputations(hosts: DataFrame) -> DataFrame:
    """Rows (host, mean, bound) for rows (host, n, bad): labelled pages and bad ones among them."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stored(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total.bad / total.n if total.n else 0.0

    def summed(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = stored(summed("suffix").withColumn("mean", F.lit(overall)), "suffixes")
    strength = _strength(suffixes)
    suffixes = suffixes.select("suffix", _shrunk(suffixes, strength).alias("mean"))
    domains = stored(summed("domain", "suffix").join(suffixes, "suffix"), "domains")
    strength = _strength(domains)
    domains = domains.select("domain", _shrunk(domains, strength).alias("mean"))
    named = stored(hosts.join(stored(domains, "domains"), "domain"), "hosts")
    strength = _strength(named)
    mean, size = _shrunk(named, strength), F.lit(strength) + F.col("n")
    return named.select(
        "host",
        mean.alias("mean"),
        (mean - BOUND * F.sqrt(mean * (1 - mean) / (size + 1))).alias("bound"),
    )


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict) for pages (page_id, url).

    ``labels`` (doc_id, quality, toxic) says of the page with that id whether it is bad: of quality
    0, or toxic.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    bad = F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)) + F.coalesce(
        (F.col("toxic") == 1).cast("int"), F.lit(0)
    )
    outcome = (
        labels.where("quality IS NOT NULL OR toxic IS NOT NULL")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.max((bad > 0).cast("int")).alias("bad"))
    )
    hosts = (
        pages.join(outcome, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    known = stored(reputations(hosts), "reputations")
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return pages.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict")
    )


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
o AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
h0 AS (
  SELECT host, count(o.bad) AS n, coalesce(sum(o.bad), 0) AS bad,
    string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l
  FROM p LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (
  SELECT *, CASE WHEN length(l[-1]) = 2
    AND coalesce(l[-2] IN ('co','com','net','org','ac','gov','edu'), false)
    THEN 2 ELSE 1 END AS k FROM h0),
h AS (
  SELECT host, n, bad, array_to_string(l[greatest(len(l) - k, 1):], '.') AS domain,
    array_to_string(l[greatest(len(l) - k + 1, 1):], '.') AS suffix FROM h1),
s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
    coalesce((SELECT sum(bad) / nullif(sum(n), 0) FROM h), 0) AS mean FROM h GROUP BY suffix),
sk AS (
  SELECT 1 / least(0.999, greatest(1e-4, coalesce((sum(n * (bad / n - mean) * (bad / n - mean))
    - sum(mean * (1 - mean))) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0))) - 1 AS k
  FROM s0 WHERE n > 0),
s AS (SELECT suffix, (k * mean + bad) / (k + n) AS mean FROM s0, sk),
d0 AS (
  SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(s.mean) AS mean
  FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
dk AS (
  SELECT 1 / least(0.999, greatest(1e-4, coalesce((sum(n * (bad / n - mean) * (bad / n - mean))
    - sum(mean * (1 - mean))) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0))) - 1 AS k
  FROM d0 WHERE n > 0),
d AS (SELECT domain, (k * mean + bad) / (k + n) AS mean FROM d0, dk),
g0 AS (SELECT host, n, bad, d.mean FROM h JOIN d USING (domain)),
gk AS (
  SELECT 1 / least(0.999, greatest(1e-4, coalesce((sum(n * (bad / n - mean) * (bad / n - mean))
    - sum(mean * (1 - mean))) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0))) - 1 AS k
  FROM g0 WHERE n > 0),
g1 AS (SELECT host, (k * mean + bad) / (k + n) AS m, k + n AS size FROM g0, gk),
g AS (SELECT host, m - 1.645 * sqrt(m * (1 - m) / (size + 1)) AS bound FROM g1),
r(rule, host, path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
fit AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule,
    arg_max(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT * FROM p) p JOIN r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, fit.rule,
  coalesce(fit.verdict, CASE WHEN g.bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN g USING (host)
LEFT JOIN fit ON p.page_id IS NOT DISTINCT FROM fit.page_id AND p.host = fit.host
  AND p.path = fit.path
"""
