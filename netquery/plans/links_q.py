"""Link measures (AG12-AG20, PR10) and the MX->A lookup (JN4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import classify_flow
from ..operators import fairness as FA
from ..operators import joins as J
from ..operators import netcalc as NC
from .derived import DENSE_SQL, PACKETS_SQL, history, packets
from .registry import query, rnd, table


def dense(spark, sf):
    return FA.densify(history(spark, sf), "t", ["client"], ["scenario"], ["throughput", "drops"])


@query("densify", oracle=f"""
WITH {DENSE_SQL}
SELECT scenario, t, client, CAST(throughput AS BIGINT) AS throughput, CAST(drops AS BIGINT) AS drops FROM dense""")
def q_densify(spark, sf):
    return dense(spark, sf).select("scenario", "t", "client", F.col("throughput").cast("long").alias("throughput"),
                                   F.col("drops").cast("long").alias("drops"))


_JAIN_SQL = """
j AS (SELECT scenario, t, CASE WHEN sum(throughput * throughput) > 0
        THEN CAST(sum(throughput) AS DOUBLE) * sum(throughput) / (count(*) * sum(throughput * throughput)) ELSE 0.0 END AS jain
      FROM dense GROUP BY scenario, t)"""


@query("jain_index", oracle=f"""
WITH {DENSE_SQL}, {_JAIN_SQL}
SELECT scenario, t, round(jain, 6) AS jain FROM j""")
def q_jain(spark, sf):
    return FA.jain(dense(spark, sf)).select("scenario", "t", rnd("jain").alias("jain"))


@query("jain_mean", oracle=f"""
WITH {DENSE_SQL}, {_JAIN_SQL}
SELECT scenario, round(avg(jain), 6) AS jain_mean FROM j GROUP BY scenario""")
def q_jain_mean(spark, sf):
    return FA.jain_mean(FA.jain(dense(spark, sf))).select("scenario", rnd("jain_mean").alias("jain_mean"))


_ALGO_SQL = ("CASE WHEN contains(client, 'Reno') THEN 'Reno' WHEN contains(client, 'Cubic') THEN 'Cubic' "
             "WHEN contains(client, 'BBR') THEN 'BBR' WHEN contains(client, 'Custom') THEN 'Custom' END")


@query("drops_by_algorithm", oracle=f"""
WITH {DENSE_SQL}
SELECT scenario, {_ALGO_SQL} AS algorithm, CAST(sum(drops) AS BIGINT) AS drops FROM dense
WHERE {_ALGO_SQL} IS NOT NULL GROUP BY ALL HAVING sum(drops) > 0""")
def q_drops_by_algorithm(spark, sf):
    return FA.drops_by_algorithm(dense(spark, sf))


@query("mean_throughput", oracle=f"""
WITH {DENSE_SQL}
SELECT scenario, client, round(avg(throughput), 6) AS mean_throughput FROM dense GROUP BY ALL""")
def q_mean_throughput(spark, sf):
    return FA.mean_throughput(dense(spark, sf)).select("scenario", "client", rnd("mean_throughput").alias("mean_throughput"))


@query("rtt_by_algorithm", oracle=f"""
WITH {DENSE_SQL}
SELECT scenario, {_ALGO_SQL} AS algorithm, round(avg(rtt_ms), 6) AS mean_rtt_ms FROM dense
WHERE {_ALGO_SQL} IS NOT NULL GROUP BY ALL""")
def q_rtt_by_algorithm(spark, sf):
    d = FA.densify(history(spark, sf), "t", ["client"], ["scenario"], ["throughput", "drops"])
    return FA.rtt_by_algorithm(d).select("scenario", "algorithm", rnd("mean_rtt_ms").alias("mean_rtt_ms"))


@query("flow_step_counts", oracle=f"""
SELECT scenario, t, client, count(*) AS attempted, CAST(count_if(served) AS BIGINT) AS served,
       CAST(count_if(NOT served) AS BIGINT) AS dropped
FROM ({PACKETS_SQL}) GROUP BY ALL""")
def q_flow_step_counts(spark, sf):
    return FA.flow_step_counts(packets(spark, sf))


@query("classify_flow", oracle=f"""
SELECT DISTINCT client, {_ALGO_SQL} AS algorithm FROM ({PACKETS_SQL})""")
def q_classify_flow(spark, sf):
    return packets(spark, sf).select("client").distinct().select("client", classify_flow("client").alias("algorithm"))


# ---- delay over a hop table: path = order, hop = line ----

def hops(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("path_id"), F.col("l_linenumber").alias("hop"),
                     (F.col("l_extendedprice") * 8).alias("bits"), (F.col("l_quantity") * 1e6).alias("rate_bps"),
                     (F.col("l_partkey") * 1000.0).alias("dist_m"), F.lit(2.5e8).alias("speed_mps"))


@query("path_delay", oracle="""
SELECT l_orderkey AS path_id, count(*) AS hops,
       round(sum(l_extendedprice * 8 / (l_quantity * 1e6)) * 1000, 6) AS transmission_ms,
       round(sum(l_partkey * 1000.0 / 2.5e8) * 1000, 6) AS propagation_ms,
       round((sum(l_extendedprice * 8 / (l_quantity * 1e6)) + sum(l_partkey * 1000.0 / 2.5e8)) * 1000, 6) AS total_ms
FROM lineitem GROUP BY l_orderkey""")
def q_path_delay(spark, sf):
    d = NC.path_delay(hops(spark, sf))
    return d.select("path_id", "hops", rnd(F.col("transmission_s") * 1000).alias("transmission_ms"),
                    rnd(F.col("propagation_s") * 1000).alias("propagation_ms"),
                    rnd(F.col("total_s") * 1000).alias("total_ms"))


@query("overload_fraction", oracle="""
WITH h AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t, count(*) AS load FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series(min(t), max(t))) AS t FROM h),
d AS (SELECT g.t, coalesce(h.load, 0) AS load FROM g LEFT JOIN h ON g.t = h.t)
SELECT round(avg(CASE WHEN load > 15 THEN 1.0 ELSE 0.0 END), 6) AS overload_fraction, count(*) AS steps FROM d""")
def q_overload_fraction(spark, sf):
    """AG20: share of hours whose offered load (events) exceeds a 15/hour link."""
    e = table(spark, sf, "events")
    h = (e.groupBy(F.floor(F.unix_timestamp("ts") / 3600).cast("long").alias("t"))
         .agg(F.count(F.lit(1)).alias("load")).withColumn("link", F.lit("all")))
    d = FA.densify(h, "t", ["link"], [], ["load"])
    return NC.overload_fraction(d, "load", 15).select(rnd("overload_fraction").alias("overload_fraction"), "steps")


# ---- MX -> A: domain = customer nation, MX = suppliers of that nation ----

@query("resolve_mail", oracle="""
WITH d AS (SELECT DISTINCT c_nationkey AS domain FROM customer),
mx AS (SELECT s_nationkey AS domain, 'mx' || CAST(s_suppkey AS VARCHAR) AS host,
              CAST(10 * row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS priority
       FROM supplier),
a AS (SELECT 'mx' || CAST(s_suppkey AS VARCHAR) AS host, s_name AS ip FROM supplier),
r AS (SELECT d.domain, mx.host, mx.priority, row_number() OVER (PARTITION BY d.domain ORDER BY mx.priority, mx.host) AS preference
      FROM d LEFT JOIN mx ON d.domain = mx.domain)
SELECT r.domain, CASE WHEN r.host IS NULL THEN NULL ELSE r.preference END AS preference, r.priority, r.host, a.ip
FROM r LEFT JOIN a ON r.host = a.host""")
def q_resolve_mail(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", "s_name")
    host = F.concat(F.lit("mx"), F.col("s_suppkey").cast("string"))
    w = Window.partitionBy("s_nationkey").orderBy(F.col("s_acctbal").desc(), F.col("s_suppkey"))
    mx = s.select(F.col("s_nationkey").alias("domain"), host.alias("host"),
                  (F.row_number().over(w) * 10).cast("int").alias("priority"))
    a = s.select(host.alias("host"), F.col("s_name").alias("ip"))
    d = table(spark, sf, "customer").select(F.col("c_nationkey").alias("domain"))
    return J.resolve_mail(d, mx, a)
