"""URL filter: rules first, else trust and distrust that spread over host edges.

Hosts are linked by the absolute links of their pages and by the domain tree (a
host and the domain it is part of, down to two labels). Personalised PageRank
spreads trust along the edges from hosts with pages that a rule allows, and
distrust against the edges from hosts with pages that a rule blocks; seeds weigh
as many pages as the rule decides. `judge` goes on until none of the last `CUT` rounds
reached a new host and they changed less than `TOLERANCE` of the mass, summed over all
hosts; the registered query ends after `ROUNDS`, as its oracle does, so hosts further
than that from every seed are allowed there.
A host that distrust reaches more than trust, by the relative `MARGIN`, is blocked.
Everything is DataFrame expressions; a round is one join and one sum over one row
for each host reached, and every `CUT` rounds a written table ends the lineage.

Defined results: a null url, or one without ://, has an empty host and path, fits
no rule and is allowed; a null page has no links; a page whose path is empty fits
only rules without a path; repeated rows are judged alike and count as seeds and
links each; an empty table gives no rows; other columns play no part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

# The rules of the query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ROUNDS, DAMPING = 8, 0.85     # ROUNDS: of the registered query and its oracle
TOLERANCE = 1e-6             # of each kind's mass
MARGIN = 1e-9                # of a host's trust
CUT = 4                      # rounds between written tables
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def domains(host: Column, least: int) -> Column:
    """The host and the domains it is part of, longest first, of at least `least` labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(n >= least, F.transform(F.sequence(F.lit(1), n - (least - 1)), lambda i: F.array_join(F.slice(labels, i, n), "."))).otherwise(F.array().cast("array<string>"))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    r = spark.createDataFrame(list(rules), "rule string, rule_verdict string")
    return r.select("rule", "rule_verdict", F.substring_index("rule", "/", 1).alias("domain"),
                    F.when(F.instr("rule", "/") > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("prefix"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of each host's domains, longest first."""
    fit = hosts.where("host <> ''").select("host", F.explode(domains(F.col("host"), 1)).alias("domain")).join(rules, "domain")
    one = F.struct((-F.length("rule")).alias("order"), "rule", "rule_verdict", "prefix")
    return fit.groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("rules"))     # as many as rules at most


def edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between hosts: links of pages, and the domain tree."""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    links = links.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    links = written(links, "links")
    hosts = pages.select("host").distinct().unionByName(links.select(F.col("dst").alias("host"))).where("host <> ''").distinct()
    chain = hosts.select(domains(F.col("host"), 2).alias("d")).where(F.size("d") > 1)
    up = chain.select(F.explode(F.arrays_zip(F.slice("d", F.lit(1), F.size("d") - 1).alias("src"), F.slice("d", F.lit(2), F.size("d") - 1).alias("dst"))).alias("e"))
    up = up.select("e.src", "e.dst").distinct()
    tree = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1).cast("long"))
    return links.unionByName(tree).where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def shares(e: DataFrame) -> DataFrame:
    """(kind, src, dst, share): trust goes along an edge, distrust against it; what leaves a host sums to 1."""
    both = e.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        e.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    whole = both.groupBy("kind", "src").agg(F.sum("weight").alias("whole"))
    return both.join(whole, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("whole")).alias("share"))


def propagate(seeds: DataFrame, share: DataFrame, rounds: int | None = None, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(kind, host, score) spread from `seeds` (kind, host, pages) in `rounds` rounds, or
    without a number until it has settled. What reaches a host without edges stays there."""
    whole = seeds.groupBy("kind").agg(F.sum("pages").alias("whole"))
    p = written(seeds.join(whole, "kind").select("kind", "host", (F.col("pages") / F.col("whole")).alias("score")), "seeds")
    score, done, settled = p, 0, False
    while not settled and done != rounds:
        last = score.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("before"))
        n = CUT if rounds is None else min(CUT, rounds - done)
        for i in range(n):
            moved = score.withColumnRenamed("host", "src").join(share, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
            kept = p.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
            both = moved.unionByName(kept)
            if rounds is None and i + 1 == n:
                both = both.withColumn("before", F.lit(0.0)).unionByName(last)
            score = both.groupBy("kind", "host").agg(*[F.sum(c).alias(c) for c in both.columns[2:]])
        score, done = written(score, "scores"), done + n
        if rounds is None:
            change = score.groupBy("kind").agg(F.sum(F.abs(F.col("score") - F.col("before"))).alias("c"), F.max((F.col("score") > 0) & (F.col("before") == 0)).alias("new")).collect()     # two rows at most
            settled = all(r.c < tolerance and not r.new for r in change)
            score = score.drop("before")
    return score


def judge(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", html: str = "html", rounds: int | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    by_host = host_rules(rows.select("host").distinct(), rule_table(spark, rules))
    fits = F.element_at(F.filter("rules", lambda r: F.col("path").startswith(r["prefix"])), 1)
    ruled = written(rows.join(by_host, "host", "left").withColumn("r", F.when(F.exists("rules", lambda r: F.col("path").startswith(r["prefix"])), fits))
                    .select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.rule_verdict").alias("decided")), "ruled")
    seeds = ruled.where("rule IS NOT NULL").groupBy(F.when(F.col("decided") == "allow", "trust").otherwise("distrust").alias("kind"), "host").agg(F.count(F.lit(1)).alias("pages"))
    share = written(shares(written(edges(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))), "edges")), "shares")
    score = propagate(seeds, share, rounds)
    level = score.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))
    out = ruled.join(level, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    method = F.when((F.col("distrust") > 0) & (F.col("distrust") > F.col("trust") * (1 + MARGIN)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"), "trust", "distrust")


def op5_url_filter(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge(pages, rounds=ROUNDS).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{r}', '{v}', '{r[:r.index('/')]}', '{r[r.index('/'):]}')" for r, v in RULES)
    rounds = "".join(f"""
s{i + 1} AS (SELECT kind, host, sum(score) AS score FROM (
  SELECT s.kind, dst AS host, s.score * share * {DAMPING} AS score FROM s{i} s JOIN share ON share.kind = s.kind AND share.src = s.host
  UNION ALL SELECT kind, host, score * (1 - {DAMPING}) FROM s0) GROUP BY kind, host),""" for i in range(ROUNDS))
    link = LINK.replace("'", "''")
    return f"""
WITH rules(rule, v, d, p) AS (VALUES {rules}),
pg AS (SELECT row_number() OVER () AS i, page_id, html, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
hit AS (SELECT i, rule, v FROM pg JOIN rules ON (host = d OR ends_with(host, '.' || d)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY i ORDER BY length(rule) DESC) = 1),
ruled AS (SELECT pg.i, page_id, host, path, rule, v FROM pg LEFT JOIN hit USING (i)),
l AS (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM pg),
h AS (SELECT host FROM pg UNION SELECT dst FROM l),
c AS (SELECT string_split(host, '.') AS x FROM h WHERE host <> ''),
up AS (SELECT DISTINCT array_to_string(x[k:], '.') AS src, array_to_string(x[k + 1:], '.') AS dst FROM c, unnest(generate_series(1, len(x) - 2)) AS u(k)),
e AS (SELECT src, dst, sum(w) AS w FROM (SELECT src, dst, 1 AS w FROM l UNION ALL SELECT src, dst, 1 FROM up UNION ALL SELECT dst, src, 1 FROM up)
      WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src, dst, w FROM e UNION ALL SELECT 'distrust', dst, src, w FROM e),
share AS (SELECT kind, src, dst, w / sum(w) OVER (PARTITION BY kind, src) AS share FROM both_ways),
seed AS (SELECT CASE v WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM ruled WHERE rule IS NOT NULL GROUP BY ALL),
s0 AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS score FROM seed),{rounds}
level AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS d FROM s{ROUNDS} GROUP BY host)
SELECT page_id, ruled.host, path, rule, coalesce(v, CASE WHEN coalesce(d, 0) > coalesce(t, 0) + 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN level ON level.host = ruled.host
"""


ORACLE = _oracle()
