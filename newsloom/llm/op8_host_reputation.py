"""URL filter: path rules first, then an empirical-Bayes reputation of the host (DataFrame functions only).

Labelled pages (labels.doc_id = page_id; quality 0 is bad) give each host k bad
pages of n. A host's bad rate has a beta prior around its registered domain's
rate, that one around its public suffix's, that one around the whole. The strength of
each prior comes from the data: the beta-binomial overdispersion rho of the
children, by moments, gives 1 / rho - 1 pseudo-pages. A page is blocked when its
host's bad rate is above `max_bad` with a posterior chance of `sure` at least, that
is when the lower posterior bound is above it; the chance is the tail of the beta
posterior, integrated numerically. Hosts without labels have their parents' prior.

Pages are aggregated to hosts, once, before anything is joined, and each level is
handed over as a table; of a level only its sums reach the driver (one row). The host
table goes back by a join on host, whose hot hosts AQE splits. Only page_id and url
are read.

User info and port don't count for the registered domain; an address of digits is its
own domain. Null urls and urls without :// have empty host and path, fit no rule and
share one reputation. Repeated page_ids are judged row by row; a doc_id labelled twice
counts with its lowest quality, null quality not at all. Empty table: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, handover, table

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: (verdict, rule): host, then path from the first slash on.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def parts(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.regexp_extract(url, URL, 2)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest becomes the outermost
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# Public suffixes of two labels under which many sites register; below all others the last label is the suffix.
TWO_LABELS = [
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au", "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr", "re.kr",
    "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.hk", "edu.hk", "gov.hk", "org.hk", "com.tw", "edu.tw", "gov.tw", "org.tw",
    "ac.in", "co.in", "edu.in", "gov.in", "net.in", "org.in", "com.sg", "edu.sg", "gov.sg", "org.sg", "com.my", "com.ph", "co.th", "or.th",
    "co.id", "go.id", "or.id", "com.vn", "com.pk", "com.bd", "com.br", "edu.br", "gov.br", "net.br", "org.br", "com.ar", "gob.ar",
    "com.mx", "gob.mx", "org.mx", "com.co", "com.pe", "com.ve", "com.tr", "edu.tr", "gov.tr", "org.tr", "com.ua", "com.pl", "edu.pl", "gov.pl",
    "ac.il", "co.il", "org.il", "ac.za", "co.za", "gov.za", "org.za", "com.eg", "com.ng", "co.ke", "com.sa", "com.gr", "com.pt", "com.es",
    "github.io", "gitlab.io", "blogspot.com", "wordpress.com",
]

NAME = r"^(?:[^@]*@)?([^:]*)"
LAST_TWO, LAST_THREE, LAST = r"([^.]+\.[^.]+)$", r"([^.]+\.[^.]+\.[^.]+)$", r"([^.]*)$"


def registered(host: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host."""
    name = F.regexp_extract(host, NAME, 1)
    two = F.regexp_extract(name, LAST_TWO, 1)
    double = two.isin(TWO_LABELS)
    suffix = F.when(double, two).otherwise(F.regexp_extract(name, LAST, 1))
    domain = F.when(double, F.regexp_extract(name, LAST_THREE, 1)).otherwise(two)
    own = name.rlike(r"^[0-9.]+$") | name.startswith("[")
    return F.when(own, name).otherwise(F.coalesce(F.nullif(domain, F.lit("")), name)), F.when(own, F.lit("")).otherwise(suffix)


def strength(level: DataFrame) -> float:
    """Pseudo-pages of the common prior of rows (k, n, m: their parent's mean); one row of sums comes to the driver."""
    k, n, m = F.col("k"), F.col("n"), F.col("m")
    over = F.sum(F.pow(k - n * m, F.lit(2))) - F.sum(n * m * (1 - m))
    pairs = F.sum(n * (n - 1) * m * (1 - m))
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.5), F.coalesce(F.try_divide(over, pairs), F.lit(0.5))))
    return level.agg((1 / rho - 1).alias("s")).first().s


def _log_gamma(z: Column) -> Column:
    """Stirling's series, eight up."""
    up = z + 8
    down = z
    for i in range(1, 8):
        down = down * (z + i)
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * up * up * up) + 1 / (1260 * F.pow(up, F.lit(5))) - F.log(down)


CELLS = 200


def chance_above(a: Column, b: Column, at: float) -> Column:
    """P(x > at) of a beta(a, b), a + b >= 1: Simpson's rule over the angle whose squared sine is x.

    One of a and b is 0.5 or more, so one side of `at` has a bounded integrand; it is
    integrated within 12 deviations of the mean, where all of the mass is.
    """
    angle, half = math.asin(math.sqrt(at)), math.pi / 2
    upper = b >= 0.5
    wide, mid = 6.0 / F.sqrt(a + b), F.asin(F.sqrt(a / (a + b)))
    begin = F.when(upper, F.greatest(F.lit(angle), mid - wide)).otherwise(F.greatest(F.lit(0.0), mid - wide))
    end = F.when(upper, F.least(F.lit(half), mid + wide)).otherwise(F.least(F.lit(angle), mid + wide))
    step = F.greatest(end - begin, F.lit(0.0)) / CELLS
    constant = math.log(2) + _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)

    def term(total, i):
        x = begin + i * step
        weight = F.when((i == 0) | (i == CELLS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        value = F.exp(constant + (2 * a - 1) * F.log(F.greatest(F.sin(x), F.lit(1e-300))) + (2 * b - 1) * F.log(F.greatest(F.cos(x), F.lit(1e-300))))
        return total + weight * value

    area = F.aggregate(F.sequence(F.lit(0), F.lit(CELLS)), F.lit(0.0), term) * step / 3
    return F.when(upper, area).otherwise(1 - area)


def reputation(hosts: DataFrame, max_bad: float = 0.5) -> DataFrame:
    """host, chance that its bad rate is above max_bad: hosts has host, k (bad), n (labelled), one row per host."""
    domain, suffix = registered(F.col("host"))
    hosts = hosts.select("host", "k", "n", domain.alias("domain"), suffix.alias("suffix"))
    domains = handover(hosts.groupBy("domain", "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n")), "domains")
    suffixes = handover(domains.groupBy("suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n")), "suffixes")
    whole = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")).first().m
    mean = lambda s: ((F.col("k") + s * F.col("m")) / (F.col("n") + s))
    suffixes = suffixes.withColumn("m", F.lit(whole))
    suffixes = suffixes.select("suffix", mean(strength(suffixes)).alias("m"))
    domains = handover(domains.join(suffixes, "suffix"), "domain-priors")
    domains = domains.select("domain", mean(strength(domains)).alias("m"))
    hosts = handover(hosts.select("host", "k", "n", "domain").join(domains, "domain").select("host", "k", "n", "m"), "host-priors")
    s = strength(hosts)
    a, b = F.col("k") + s * F.col("m"), F.col("n") - F.col("k") + s * (1 - F.col("m"))
    return hosts.select("host", a.alias("a"), b.alias("b")).select("host", chance_above(F.col("a"), F.col("b"), max_bad).alias("chance"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, sure: float = 0.95, max_bad: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, chance."""
    host, path = parts(F.col("url"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"))
    outcome = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg((F.min("quality") == 0).cast("long").alias("bad"))
    hosts = base.select("page_id", "host").join(outcome, "page_id", "left").groupBy("host")
    hosts = handover(hosts.agg(F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"), F.count("bad").cast("double").alias("n")), "hosts")
    known = handover(reputation(hosts, max_bad), "reputation")
    ruled = base.withColumn("r", longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("chance") >= sure, "block").otherwise("allow")
    return ruled.join(known, "host", "left").select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"), "chance")


def op8_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("chance")


def _sql_strength(src: str) -> str:
    return f"""(SELECT 1 / greatest(0.001::DOUBLE, least(0.5::DOUBLE, coalesce(
        (sum(pow(k - n * m, 2)) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.5::DOUBLE))) - 1 FROM {src})"""


_FITS = {r: f"((host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/') :]}'))" for _, r in RULES}
_LONGEST = sorted(RULES, key=lambda r: -len(r[1]))
_X = f"(lo + i * st / {CELLS})"
SQL = f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages
),
l AS (SELECT doc_id AS page_id, CAST(min(quality) = 0 AS BIGINT) AS bad FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
g AS (SELECT host, regexp_extract(host, '{NAME}', 1) AS name, coalesce(sum(bad), 0)::DOUBLE AS k, count(bad)::DOUBLE AS n
      FROM u LEFT JOIN l USING (page_id) GROUP BY host),
e AS (SELECT *, regexp_extract(name, '{LAST_TWO}', 1) AS two, regexp_matches(name, '^[0-9.]+$') OR starts_with(name, '[') AS own FROM g),
h AS (SELECT host, k, n,
        CASE WHEN own THEN name ELSE coalesce(nullif(CASE WHEN two IN {tuple(TWO_LABELS)} THEN regexp_extract(name, '{LAST_THREE}', 1) ELSE two END, ''), name) END AS domain,
        CASE WHEN own THEN '' WHEN two IN {tuple(TWO_LABELS)} THEN two ELSE regexp_extract(name, '{LAST}', 1) END AS suffix FROM e),
s0 AS (SELECT suffix, sum(k) AS k, sum(n) AS n, (sum(sum(k)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS m FROM h GROUP BY suffix),
s AS (SELECT suffix, (k + st * m) / (n + st) AS m FROM (SELECT *, {_sql_strength('s0')} AS st FROM s0)),
d0 AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n, any_value(s.m) AS m FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
d AS (SELECT domain, (k + st * m) / (n + st) AS m FROM (SELECT *, {_sql_strength('d0')} AS st FROM d0)),
h0 AS (SELECT host, k, n, d.m FROM h JOIN d USING (domain)),
h1 AS (SELECT host, k + st * m AS a, n - k + st * (1 - m) AS b FROM (SELECT *, {_sql_strength('h0')} AS st FROM h0)),
h2 AS (SELECT *, b >= 0.5 AS upper, 6.0::DOUBLE / sqrt(a + b) AS wide, asin(sqrt(a / (a + b))) AS mid FROM h1),
h3 AS (SELECT host, a, b, upper, CASE WHEN upper THEN greatest(pi() / 4, mid - wide) ELSE greatest(0, mid - wide) END AS lo,
              CASE WHEN upper THEN least(pi() / 2, mid + wide) ELSE least(pi() / 4, mid + wide) END AS hi FROM h2),
h4 AS (SELECT *, greatest(hi - lo, 0) AS st FROM h3),
h5 AS (
  SELECT host, any_value(upper) AS upper,
         sum(CASE WHEN i IN (0, {CELLS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(ln(2) + lgamma(a + b) - lgamma(a) - lgamma(b)
             + (2 * a - 1) * ln(greatest(sin({_X}), 1e-300)) + (2 * b - 1) * ln(greatest(cos({_X}), 1e-300)))) * any_value(st) / {CELLS} / 3 AS area
  FROM h4, range(0, {CELLS} + 1) t(i) GROUP BY host
),
r AS (SELECT host, CASE WHEN upper THEN area ELSE 1 - area END AS chance FROM h5)
SELECT page_id, host, path,
       CASE {' '.join(f"WHEN {_FITS[r]} THEN '{r}'" for _, r in _LONGEST)} END AS rule,
       CASE {' '.join(f"WHEN {_FITS[r]} THEN '{v}'" for v, r in _LONGEST)} WHEN chance >= 0.95 THEN 'block' ELSE 'allow' END AS verdict
FROM u JOIN r USING (host)
"""
