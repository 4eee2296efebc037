"""URL filters: rules first, then empirical-Bayes reputation of the host.

Pages that a rule decides are labelled outcomes (allowed: good, blocked: bad), and labels of other
pages may be given. They are shrunk through beta-binomial priors: a host's prior
is centred on the posterior mean of its registered domain, that one's on its suffix, and that one's
on all pages. How strongly a level shrinks follows from the spread of its members' rates (the
moments of the beta-binomial). A host is blocked if the lower bound of its posterior bad rate lies
above a threshold, so a host without bad evidence of its own or of its domain is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

# (action, rule); a rule is a host, then the beginning of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two parts under which names are registered; a parameter, extend it as needed.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")
THRESHOLD = 0.5
BOUND = 1.645  # standard deviations: a one-sided bound of 95 %


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, else null. The rules become one expression: meant for a list of
    hundreds, given by the user, not for one that grows with the data."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def domain_of(host: Column, two_part: Sequence[str] = TWO_PART_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix). A port is no part of either; an IPv4 address is its own domain."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    parts = F.split(name, r"\.")
    n = F.size(parts)
    last = F.element_at(parts, -1)
    pair = F.when(n >= 2, F.concat_ws(".", F.slice(parts, -2, 2)))
    long = F.coalesce(pair.isin(*two_part), F.lit(False)) & (n >= 3)
    triple = F.when(n >= 3, F.concat_ws(".", F.slice(parts, -3, 3)))
    numeric = name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    domain = F.when(numeric, name).when(long, triple).otherwise(F.coalesce(pair, name))
    suffix = F.when(numeric, F.lit("")).when(long, pair).otherwise(last)
    return domain, suffix


def _strength(level: DataFrame) -> tuple[float, float]:
    """Mean bad rate and prior strength of a level (one row per member: n, bad), from one row of sums.

    One-way analysis of variance of 0/1 outcomes: the correlation within members is
    (MSB - MSW) / (MSB + (n0 - 1) MSW), and the strength of the beta prior is 1 / correlation - 1.
    The correlation is held between 0.001 and 0.9; with fewer than two members it is taken as 0.01.
    """
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    k, total, bads, between, squares = (
        level.filter("n > 0")
        .agg(F.count(F.lit(1)), F.sum(n), F.sum(bad), F.sum(bad * bad / n), F.sum(n * n))
        .first()
    )
    if not k:
        return 0.5, 1 / 0.01 - 1
    rho = 0.01
    if k > 1 and total > k:
        msb = (between - bads * bads / total) / (k - 1)
        msw = (bads - between) / (total - k)
        n0 = (total - squares / total) / (k - 1)
        whole = msb + (n0 - 1) * msw
        rho = (msb - msw) / whole if whole else 0.01
    return (bads + 0.5) / (total + 1), 1 / min(max(rho, 0.001), 0.9) - 1


def host_reputation(pages: DataFrame, threshold: float = THRESHOLD, bound: float = BOUND) -> DataFrame:
    """Per host of ``pages`` (host, bad): n, bad, bad_rate, bad_rate_low, blocked.

    ``bad`` is the outcome of a labelled page and null for others. Hosts without outcomes are judged by
    the prior of their domain; where that has no bad outcome either, the host is not blocked, whatever
    the rates elsewhere.
    """
    domain, suffix = domain_of(F.col("host"))
    hosts = written(
        pages.groupBy("host")
        .agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix}),
        "host-outcomes",
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)

    mean, of_suffixes = _strength(suffixes)
    of_domains, of_hosts = _strength(domains)[1], _strength(hosts)[1]

    def shrunk(prior: Column | float, strength: float) -> Column:
        return (F.col("bad") + F.lit(strength) * prior) / (F.col("n") + F.lit(strength))

    suffix_rates = suffixes.select("suffix", shrunk(F.lit(mean), of_suffixes).alias("prior"))
    domain_rates = domains.join(suffix_rates, "suffix").select(
        "domain", "suffix", shrunk(F.col("prior"), of_domains).alias("prior"), (F.col("bad") > 0).alias("domain_bad")
    )
    rate = shrunk(F.col("prior"), of_hosts)
    low = rate - F.lit(bound) * F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(of_hosts) + 1))
    return hosts.join(domain_rates, ["domain", "suffix"]).select(
        "host", "n", "bad", rate.alias("bad_rate"), low.alias("bad_rate_low"),
        ((low > threshold) & F.col("domain_bad")).alias("blocked"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = THRESHOLD,
    bound: float = BOUND,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, bad_rate, bad_rate_low.

    A null url, or one without ``://``, has an empty host and path, and is judged like a host of that
    name. Pages with a rule are outcomes; ``outcomes`` (page_id, bad), if given, adds those of pages
    without one, where neither is null. Repeated rows count and are judged each; empty tables give no
    rows; other columns are not read. Without any outcome every host gets the same prior of one half
    and is allowed.
    """
    url = F.col(url_col)
    actions = {rule: action for action, rule in rules}
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, action in actions.items():
        by_rule = F.when(F.col("rule") == rule, action).otherwise(by_rule)
    labelled = ruled.select("page_id", "host", (by_rule == "block").alias("bad"))
    if outcomes is not None:
        # One outcome per page: bad if any row says so.
        given = outcomes.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("said"))
        labelled = labelled.join(given, "page_id", "left").select("host", F.coalesce("bad", "said").alias("bad"))
    hosts = written(host_reputation(labelled, threshold, bound), "host-reputation")
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return ruled.join(hosts, "host").select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"), "bad_rate", "bad_rate_low"
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p
), h AS (
  SELECT host, count(rule) AS n,
         count(*) FILTER (WHERE rule IN ('example.com/en/', 'net/es/', 'net/fr/')) AS bad,
         regexp_replace(host, ':[0-9]*$', '') AS name
  FROM ruled GROUP BY host
), hosts AS (
  SELECT *, string_split(name, '.') AS parts,
         regexp_matches(name, '^[0-9]+(\.[0-9]+){3}$') AS numeric,
         len(string_split(name, '.')) >= 3 AND array_to_string(string_split(name, '.')[-2:], '.') IN
           ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.za') AS two_part
  FROM h
), host_level AS (
  SELECT host, n, bad,
         CASE WHEN numeric THEN name WHEN two_part THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain,
         CASE WHEN numeric THEN '' WHEN two_part THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix
  FROM hosts
), domain_level AS (
  SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM host_level GROUP BY domain, suffix
), suffix_level AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domain_level GROUP BY suffix
), sums AS (
  SELECT level, count(*) AS k, sum(n)::DOUBLE AS total, sum(bad)::DOUBLE AS bads,
         sum(bad::DOUBLE * bad / n) AS between_, sum(n::DOUBLE * n) AS squares
  FROM (SELECT 'host' AS level, n, bad FROM host_level UNION ALL
        SELECT 'domain', n, bad FROM domain_level UNION ALL
        SELECT 'suffix', n, bad FROM suffix_level)
  WHERE n > 0 GROUP BY level
), squares AS (
  SELECT level, (bads + 0.5) / (total + 1) AS mean, k, total,
         (between_ - bads * bads / total) / nullif(k - 1, 0) AS msb,
         (bads - between_) / nullif(total - k, 0) AS msw,
         (total - squares / total) / nullif(k - 1, 0) AS n0
  FROM sums
), strengths AS (
  SELECT level, mean,
         1 / least(greatest(coalesce((msb - msw) / nullif(msb + (n0 - 1) * msw, 0), 0.01), 0.001), 0.9) - 1 AS strength
  FROM squares
), s AS (SELECT coalesce(max(mean), 0.5) AS mean, coalesce(max(strength), 99.0) AS strength FROM strengths WHERE level = 'suffix'),
d AS (SELECT coalesce(max(strength), 99.0) AS strength FROM strengths WHERE level = 'domain'),
t AS (SELECT coalesce(max(strength), 99.0) AS strength FROM strengths WHERE level = 'host'),
suffix_rate AS (
  SELECT suffix, (bad + s.strength * s.mean) / (n + s.strength) AS prior FROM suffix_level, s
), domain_rate AS (
  SELECT domain, suffix, (bad + d.strength * prior) / (n + d.strength) AS prior, bad > 0 AS domain_bad
  FROM domain_level JOIN suffix_rate USING (suffix), d
), host_rate AS (
  SELECT host, domain_bad, n + t.strength AS total, (bad + t.strength * prior) / (n + t.strength) AS rate
  FROM host_level JOIN domain_rate USING (domain, suffix), t
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN domain_bad AND rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN host_rate USING (host)
"""
