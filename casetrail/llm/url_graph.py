"""URL filter: path rules first, link-graph propagation for the rest; DataFrame functions only.

A rule is (action, host/path).  It fits its host and all subdomains if the url's path starts
with the rule's path; the longest fitting rule decides.  Urls that no rule fits are judged by
their host: links between hosts form a weighted graph, trust walks along links from trusted
seed hosts and distrust walks against links from blocked seed hosts (personalised PageRank,
restarting at the seeds).  A host is blocked if distrust that reached it makes up more than
``share`` of the mass that reached it.  The restart mass at a seed itself isn't counted: a host
is not blocked for its own rule.  A host is a seed if the rules decide most of its pages alike;
one that links point to but that has no page here is a seed if a rule for whole hosts decides it.

The walk is a truncated power series: in each round every host passes ``damping`` of its
arrived mass to its neighbours; rounds end when no mass moves, or when what can still move is
below ``tolerance`` of the seeds' mass.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and
is allowed; a null html has no links; repeated rows each get their row (and repeat their links'
weight); an empty table gives an empty table; other columns are ignored.  Of fitting rules of
equal length the first in text order decides; a distrust of exactly ``share`` doesn't block.  Html
of any length is searched whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Fixed values of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

DAMPING = 0.85
TOLERANCE = 1e-3
SHARE = 0.5


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, action); null if none fits."""
    fitting = []
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        fitting.append(F.when(fits, F.struct(F.lit(rule).alias("rule"),
                                             F.lit(action).alias("action"))))
    return F.coalesce(*fitting)


def host_links(pages: DataFrame) -> DataFrame:
    """Weighted links between different hosts: (src, dst, weight)."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(
        F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), 1)).alias("href"))
    whole = F.when(F.col("href").startswith("//"),
                   F.concat(F.lit("http:"), F.col("href"))).otherwise(F.col("href"))
    return (links.select("src", host_of(whole).alias("dst"))
            .filter((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != ""))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")))


def rounds_of(damping: float, tolerance: float) -> int:
    """Rounds after which at most ``tolerance`` of the seeds' mass still moves."""
    return math.ceil(math.log(tolerance) / math.log(damping))


def seeds(parsed: DataFrame, links: DataFrame, rules=RULES) -> DataFrame:
    """Seed hosts (host, walk, mass): hosts most of whose pages the rules decide alike, and
    targets of links without a page that a rule for whole hosts decides."""
    action = rule_of(F.col("host"), F.lit("/"), rules)["action"]
    beyond = (links.select(F.col("dst").alias("host")).distinct()
              .join(parsed.select("host").distinct(), "host", "left_anti")
              .select("host", F.when(action == "allow", "trust")
                      .when(action == "block", "distrust").alias("walk")))
    hosts = parsed.filter(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("action") == "allow").alias("trust"),
        F.count_if(F.col("action") == "block").alias("distrust"))
    return (hosts.select("host", F.when(2 * F.col("trust") > F.col("n"), "trust")
                         .when(2 * F.col("distrust") > F.col("n"), "distrust").alias("walk"))
            .unionByName(beyond).filter("walk is not null").withColumn("mass", F.lit(1.0)))


def propagate(links: DataFrame, seed: DataFrame, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """Mass that reached each host from other hosts: (host, trust, distrust)."""
    along = links.select(F.lit("trust").alias("walk"), "src", "dst", "weight")
    against = links.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"),
                           F.col("src").alias("dst"), "weight")
    both = along.unionByName(against)
    out = both.groupBy("walk", "src").agg(F.sum("weight").alias("total"))
    edges = stored(both.join(out, ["walk", "src"])
                   .select("walk", "src", "dst", (F.col("weight") / F.col("total")).alias("p")),
                   "host-links")
    moving = seed
    arrived = []
    for _ in range(rounds_of(damping, tolerance)):
        moving = stored(
            moving.join(edges, (moving["walk"] == edges["walk"]) & (moving["host"] == edges["src"]))
            .groupBy(F.col("dst").alias("host"), edges["walk"].alias("walk"))
            .agg((F.sum(moving["mass"] * edges["p"]) * damping).alias("mass")), "walk")
        if moving.isEmpty():
            break
        arrived.append(moving)
    total = moving
    for part in arrived[:-1] if arrived and moving is arrived[-1] else arrived:
        total = total.unionByName(part)
    return total.groupBy("host").agg(
        F.sum(F.when(F.col("walk") == "trust", F.col("mass")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("walk") == "distrust", F.col("mass")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING,
          tolerance: float = TOLERANCE, share: float = SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    parsed = (pages.select("page_id", host_of(F.col("url")).alias("host"),
                           path_of(F.col("url")).alias("path"))
              .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
              .select("page_id", "host", "path", "_rule.rule", "_rule.action"))
    links = stored(host_links(pages), "host-graph")
    mass = propagate(links, seeds(parsed, links, rules), damping, tolerance)
    blocked = stored(mass.filter(F.col("distrust") > share * (F.col("trust") + F.col("distrust")))
                     .select("host", F.lit("block").alias("by_links")), "blocked-hosts")
    return (parsed.join(blocked, "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("action", "by_links", F.lit("allow")).alias("verdict")))


def oracle_sql(rules=RULES, damping: float = DAMPING, tolerance: float = TOLERANCE,
               share: float = SHARE) -> str:
    """The same judgement in DuckDB SQL, one CTE for each round."""
    rounds = rounds_of(damping, tolerance)

    def parts(url: str) -> str:
        pattern = "'^.*?://([^/?#]*)([^?#]*)'"
        return (f"translate(regexp_extract(coalesce({url}, ''), {pattern}, 1, 's'), "
                f"'{UPPER}', '{LOWER}') AS host, "
                f"regexp_extract(coalesce({url}, ''), {pattern}, 2, 's') AS path")
    table = ", ".join(f"('{a}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')"
                      for a, r in rules)
    link = LINK.replace("(?i)", "").replace("'", "''")
    ctes = [
        f"rules(action, rule, rule_host, rule_path) AS (VALUES {table})",
        f"urls AS (SELECT row_number() OVER () AS n, page_id, html, {parts('url')} FROM pages)",
        "fits AS (SELECT n, rules.*, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, "
        "rule) AS nth FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || "
        "rule_host)) AND starts_with(path, rule_path))",
        "parsed AS (SELECT urls.*, rule, action FROM urls LEFT JOIN fits "
        "ON urls.n = fits.n AND nth = 1)",
        f"hrefs AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1,"
        " 'i')) AS href FROM urls)",
        f"targets AS (SELECT src, {parts('''CASE WHEN starts_with(href, '//') THEN 'http:' || href ELSE href END''')} FROM hrefs)",
        "links AS (SELECT src, host AS dst, count(*) AS weight FROM targets "
        "WHERE src <> host AND src <> '' AND host <> '' GROUP BY ALL)",
        "both_ways AS (SELECT 'trust' AS walk, src, dst, weight FROM links UNION ALL "
        "SELECT 'distrust', dst, src, weight FROM links)",
        "edges AS (SELECT walk, src, dst, weight / sum(weight) OVER (PARTITION BY walk, src) AS p "
        "FROM both_ways)",
        "r0 AS (SELECT host, CASE WHEN 2 * count(*) FILTER (action = 'allow') > count(*) "
        "THEN 'trust' WHEN 2 * count(*) FILTER (action = 'block') > count(*) THEN 'distrust' END "
        "AS walk, 1.0::double AS mass FROM parsed WHERE host <> '' GROUP BY host UNION ALL "
        "SELECT dst, CASE arg_max(action, length(rule) * 1000000 - nth) WHEN 'allow' THEN 'trust' "
        "WHEN 'block' THEN 'distrust' END, 1.0::double FROM (SELECT DISTINCT dst FROM links "
        "WHERE dst NOT IN (SELECT host FROM parsed)) t JOIN "
        "(SELECT *, row_number() OVER (ORDER BY rule) AS nth FROM rules) w "
        "ON (dst = rule_host OR ends_with(dst, '.' || rule_host)) AND rule_path = '/' GROUP BY dst)",
    ]
    for k in range(1, rounds + 1):
        ctes.append(f"r{k} AS (SELECT dst AS host, e.walk, sum(mass * p) * {damping} AS mass "
                    f"FROM r{k - 1} r JOIN edges e ON r.walk = e.walk AND host = src GROUP BY 1, 2)")
    arrived = " UNION ALL ".join(f"SELECT * FROM r{k}" for k in range(1, rounds + 1))
    ctes.append(f"arrived AS ({arrived})")
    ctes.append(f"blocked AS (SELECT host, 'block' AS by_links FROM arrived GROUP BY host HAVING "
                f"coalesce(sum(mass) FILTER (walk = 'distrust'), 0) > {share} * sum(mass))")
    return (f"WITH {', '.join(ctes)} SELECT page_id, parsed.host, path, rule, "
            "coalesce(action, by_links, 'allow') AS verdict FROM parsed LEFT JOIN blocked "
            "ON parsed.host = blocked.host")
