"""Keeping copies in step: inclusion facts, tombstones and fences, digests, snapshot repair and enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.registry import query
from quillfold.sources.tables import FEED_SQL, feed, load

FACTS_SQL = f"""{FEED_SQL}, facts AS (SELECT source_id AS build, document_uid, CASE kind WHEN 'error' THEN 'removed' WHEN 'click' THEN 'pending' ELSE 'included' END AS state, CAST(round(value) AS BIGINT) AS fact_version, position, occurred_us FROM feed),
    cur AS (SELECT build, document_uid, arg_max(state, struct_pack(v := fact_version, p := position)) AS state, max(fact_version) AS fact_version FROM facts GROUP BY 1, 2)"""


def facts(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("kind") == "error", "removed").when(F.col("kind") == "click", "pending").otherwise("included")
    return feed(spark, d).select(F.col("source_id").alias("build"), "document_uid", state.alias("state"), F.round("value").cast("long").alias("fact_version"), "position", "occurred_us")


def current(f: DataFrame) -> DataFrame:
    """The highest version of each fact wins; an equal one that comes later is applied again."""
    return f.groupBy("build", "document_uid").agg(F.max_by("state", F.struct("fact_version", "position")).alias("state"), F.max("fact_version").alias("fact_version"))


@query("facts_current", f"WITH {FACTS_SQL} SELECT * FROM cur")
def facts_current(spark: SparkSession, d: str) -> DataFrame:
    return current(facts(spark, d))


@query("facts_applied", f"WITH {FACTS_SQL}, x AS (SELECT *, max(fact_version) OVER (PARTITION BY build, document_uid ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM facts) SELECT position, CASE WHEN top IS NULL OR fact_version > top THEN 'applied' WHEN fact_version = top THEN 'reapplied' ELSE 'ignored' END AS verdict FROM x")
def facts_applied(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("build", "document_uid").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    x = facts(spark, d).withColumn("top", F.max("fact_version").over(w))
    return x.select("position", F.when(F.col("top").isNull() | (F.col("fact_version") > F.col("top")), "applied").when(F.col("fact_version") == F.col("top"), "reapplied").otherwise("ignored").alias("verdict"))


@query("inclusion_rule", f"WITH {FACTS_SQL}, k AS (SELECT document_uid, list_distinct(list(kind)) AS kinds, max(value) AS v FROM feed GROUP BY 1) SELECT document_uid, list_contains(kinds, 'purchase') AND list_contains(kinds, 'signup') AND v > 90 AND NOT document_uid LIKE '%7' AS included FROM k")
def inclusion_rule(spark: SparkSession, d: str) -> DataFrame:
    """Bound, its profile lists the projection, usable, and neither deleted nor blocked."""
    k = feed(spark, d).groupBy("document_uid").agg(F.collect_set("kind").alias("kinds"), F.max("value").alias("v"))
    ok = F.array_contains("kinds", "purchase") & F.array_contains("kinds", "signup") & (F.col("v") > 90) & ~F.col("document_uid").endswith("7")
    return k.select("document_uid", ok.alias("included"))


@query("tombstone_fence", f"WITH {FACTS_SQL}, t AS (SELECT build, document_uid, max(fact_version) AS expired, max(occurred_us) AS at FROM facts WHERE state = 'removed' GROUP BY 1, 2) SELECT f.position, coalesce(f.fact_version <= t.expired AND f.occurred_us < t.at + 86400000000, false) AS fenced FROM facts f LEFT JOIN t USING (build, document_uid) WHERE f.state <> 'removed'")
def tombstone_fence(spark: SparkSession, d: str) -> DataFrame:
    """Writes at or under an expired tombstone's version, issued before it expired, are refused."""
    f = facts(spark, d)
    t = f.where("state = 'removed'").groupBy("build", "document_uid").agg(F.max("fact_version").alias("expired"), F.max("occurred_us").alias("at"))
    x = f.where("state <> 'removed'").join(t, ["build", "document_uid"], "left")
    return x.select("position", F.coalesce((F.col("fact_version") <= F.col("expired")) & (F.col("occurred_us") < F.col("at") + 86_400_000_000), F.lit(False)).alias("fenced"))


@query("page_registration", f"WITH {FACTS_SQL} SELECT build, bool_and(fact_version > 0) AS accepted, count(*) FILTER (state = 'pending') AS pending FROM facts GROUP BY 1")
def page_registration(spark: SparkSession, d: str) -> DataFrame:
    """A page is accepted only if all of its sources are valid; what is accepted becomes pending."""
    return facts(spark, d).groupBy("build").agg(F.bool_and(F.col("fact_version") > 0).alias("accepted"), F.count_if(F.col("state") == "pending").alias("pending"))


@query("digest_heartbeat", f"WITH {FACTS_SQL}, m AS (SELECT build, document_uid, fact_version, bit_and_v FROM (SELECT *, CAST('0x' || substr(sha256(document_uid || ':' || fact_version), 1, 15) AS BIGINT) AS bit_and_v FROM cur)), a AS (SELECT build, count(*) AS n, bit_xor(bit_and_v) AS x FROM m GROUP BY 1), b AS (SELECT build, count(*) AS n, bit_xor(bit_and_v) AS x FROM m WHERE NOT (build % 3 = 0 AND document_uid LIKE '%3') GROUP BY 1) SELECT build, a.n AS platform_n, b.n AS consumer_n, a.n IS DISTINCT FROM b.n OR a.x IS DISTINCT FROM b.x AS repair FROM a LEFT JOIN b USING (build)")
def digest_heartbeat(spark: SparkSession, d: str) -> DataFrame:
    """Count and digest of both sides; a mismatch asks for repair."""
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", "document_uid", F.col("fact_version").cast("string")), 256), 1, 15), 16, 10).cast("long")
    m = current(facts(spark, d)).withColumn("h", h)
    lost = (F.col("build") % 3 == 0) & F.col("document_uid").endswith("3")
    g = m.groupBy("build").agg(F.count("*").alias("platform_n"), F.bit_xor("h").alias("a"), F.count_if(~lost).alias("n"), F.bit_xor(F.when(~lost, F.col("h"))).alias("b"))
    consumer = F.when(F.col("n") > 0, F.col("n"))
    return g.select("build", "platform_n", consumer.alias("consumer_n"), (~F.col("platform_n").eqNullSafe(consumer) | ~F.col("a").eqNullSafe(F.col("b"))).alias("repair"))


@query("snapshot_repair", f"WITH {FACTS_SQL}, v AS (SELECT build, document_uid FROM cur WHERE fact_version % 3 <> 0 UNION ALL SELECT build, document_uid || '_new' FROM cur WHERE fact_version % 11 = 0) SELECT coalesce(c.build, v.build) AS build, coalesce(c.document_uid, v.document_uid) AS document_uid, CASE WHEN c.fact_version > 60 THEN c.state WHEN v.build IS NOT NULL THEN 'included' ELSE 'removed' END AS state, CASE WHEN c.fact_version > 60 THEN c.fact_version ELSE 60 END AS fact_version FROM cur c FULL JOIN v ON v.build = c.build AND v.document_uid = c.document_uid")
def snapshot_repair(spark: SparkSession, d: str) -> DataFrame:
    """Replacement by a view at watermark 60: newer facts stay, those in the view get its stamp, the others are removed at it."""
    c = current(facts(spark, d))
    view = c.where("fact_version % 3 <> 0").select("build", "document_uid").union(c.where("fact_version % 11 = 0").select("build", F.concat("document_uid", F.lit("_new")))).withColumn("there", F.lit(True))
    both = c.join(view, ["build", "document_uid"], "full")
    newer = F.coalesce(F.col("fact_version") > 60, F.lit(False))
    return both.select("build", "document_uid", F.when(newer, F.col("state")).when(F.col("there"), "included").otherwise("removed").alias("state"), F.when(newer, F.col("fact_version")).otherwise(F.lit(60).cast("long")).alias("fact_version"))


@query("enforcement", f"WITH {FACTS_SQL} SELECT d.document_uid, NOT EXISTS (SELECT 1 FROM cur c WHERE c.document_uid = d.document_uid AND c.state IN ('included', 'pending') AND c.build % 5 <> 0) AS enforced FROM (SELECT DISTINCT document_uid FROM facts) d")
def enforcement(spark: SparkSession, d: str) -> DataFrame:
    """A removal is enforced when no build in use holds the document any more."""
    c = current(facts(spark, d))
    held = F.col("state").isin("included", "pending") & (F.col("build") % 5 != 0)
    return c.groupBy("document_uid").agg((~F.bool_or(held)).alias("enforced"))


@query("pending_age", f"WITH {FACTS_SQL}, n AS (SELECT max(occurred_us) AS now FROM facts), p AS (SELECT build, document_uid, max(occurred_us) AS since FROM facts WHERE state = 'pending' GROUP BY 1, 2) SELECT build, document_uid, now - since AS age_us, now - since > 432000000000 AS repair FROM p, n")
def pending_age(spark: SparkSession, d: str) -> DataFrame:
    f = facts(spark, d)
    now = F.broadcast(f.agg(F.max("occurred_us").alias("now")))
    p = f.where("state = 'pending'").groupBy("build", "document_uid").agg(F.max("occurred_us").alias("since")).join(now)
    age = F.col("now") - F.col("since")
    return p.select("build", "document_uid", age.alias("age_us"), (age > 432_000_000_000).alias("repair"))


@query("backfill_gate", f"WITH {FACTS_SQL}, b AS (SELECT build, quantile_disc(fact_version, 0.5) AS backfilled FROM facts GROUP BY 1) SELECT c.build, c.document_uid, c.state = 'included' AND b.backfilled >= 50 AS ready FROM cur c JOIN b USING (build)")
def backfill_gate(spark: SparkSession, d: str) -> DataFrame:
    """A build counts towards readiness once its backfill is complete enough."""
    f = facts(spark, d)
    rank = F.row_number().over(Window.partitionBy("build").orderBy("fact_version"))
    n = F.count("*").over(Window.partitionBy("build"))
    mid = f.withColumns({"k": rank, "n": n}).where(F.col("k") == F.ceil(F.col("n") / 2)).select("build", F.col("fact_version").alias("backfilled"))
    return current(f).join(mid, "build").select("build", "document_uid", ((F.col("state") == "included") & (F.col("backfilled") >= 50)).alias("ready"))


@query("invariants", f"WITH {FACTS_SQL}, x AS (SELECT build, document_uid, fact_version, state, lag(state) OVER w AS prev, lag(fact_version) OVER w AS pv FROM facts WINDOW w AS (PARTITION BY build, document_uid ORDER BY position)) SELECT 'S1' AS invariant, count(*) AS violations FROM x WHERE prev = 'removed' AND state = 'included' AND fact_version <= pv UNION ALL SELECT 'L0', count(*) FROM cur WHERE state = 'pending'")
def invariants(spark: SparkSession, d: str) -> DataFrame:
    """Safety at each step (no removed fact comes back under its version) and liveness at the end (nothing pending)."""
    f = facts(spark, d)
    w = Window.partitionBy("build", "document_uid").orderBy("position")
    x = f.withColumns({"prev": F.lag("state").over(w), "pv": F.lag("fact_version").over(w)})
    s1 = x.agg(F.lit("S1").alias("invariant"), F.count_if((F.col("prev") == "removed") & (F.col("state") == "included") & (F.col("fact_version") <= F.col("pv"))).alias("violations"))
    return s1.union(current(f).agg(F.lit("L0"), F.count_if(F.col("state") == "pending")))


@query("page_maps", f"WITH {FACTS_SQL} SELECT build, document_uid, string_agg(state || '=' || n, ',' ORDER BY state) AS sources FROM (SELECT build, document_uid, state, count(*) AS n FROM facts GROUP BY 1, 2, 3) GROUP BY 1, 2")
def page_maps(spark: SparkSession, d: str) -> DataFrame:
    """The sources of each derived page as one map, rendered in key order."""
    n = facts(spark, d).groupBy("build", "document_uid", "state").agg(F.count("*").alias("n"))
    m = n.groupBy("build", "document_uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("state", "n")))).alias("m"))
    return m.select("build", "document_uid", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("sources"))


@query("coalesced_runs", f"WITH {FEED_SQL}, x AS (SELECT document_uid, occurred_us // 3600000000 AS slot FROM feed), y AS (SELECT document_uid, slot, slot - lag(slot) OVER (PARTITION BY document_uid ORDER BY slot) AS gap FROM (SELECT DISTINCT * FROM x)) SELECT document_uid, count(*) AS slots, count(*) FILTER (gap IS NULL OR gap > 1) AS runs, count(*) FILTER (gap = 1) AS reruns FROM y GROUP BY 1")
def coalesced_runs(spark: SparkSession, d: str) -> DataFrame:
    """Signals during a run ask for one more run, however many they are."""
    x = feed(spark, d).select("document_uid", F.floor(F.col("occurred_us") / 3_600_000_000).alias("slot")).distinct()
    gap = F.col("slot") - F.lag("slot").over(Window.partitionBy("document_uid").orderBy("slot"))
    y = x.withColumn("gap", gap)
    return y.groupBy("document_uid").agg(F.count("*").alias("slots"), F.count_if(F.col("gap").isNull() | (F.col("gap") > 1)).alias("runs"), F.count_if(F.col("gap") == 1).alias("reruns"))


@query("newest_reports", f"WITH {FEED_SQL} SELECT document_uid, occurred_us // 3600000000 AS sent_in, max(position) AS sent, count(*) - 1 AS superseded FROM feed GROUP BY 1, 2")
def newest_reports(spark: SparkSession, d: str) -> DataFrame:
    """Of reports that wait for delivery only the newest is sent."""
    slot = F.floor(F.col("occurred_us") / 3_600_000_000)
    return feed(spark, d).groupBy("document_uid", slot.alias("sent_in")).agg(F.max("position").alias("sent"), (F.count("*") - 1).alias("superseded"))


@query("queue_ages", "SELECT user_id, event_type, round(avg(value), 6) AS mean_age, max(value) AS longest, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us FROM events GROUP BY 1, 2")
def queue_ages(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return load(spark, d, "events").groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("mean_age"), F.max("value").alias("longest"), (F.max(us) - F.min(us)).alias("duration_us"))
