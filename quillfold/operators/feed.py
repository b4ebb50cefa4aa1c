"""The change feed: positions, ordered reads, cursors, retention, state as of a position, and feed gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions.codecs import decode_position, hex16
from quillfold.registry import query
from quillfold.sources.tables import FEED_SQL, feed, load

DAY_US = 86_400_000_000


def page(entries: DataFrame, after: str, limit: int, key: str = "position") -> DataFrame:
    """A keyset page: the first `limit` rows after a key (a sort-free top-k, never an offset)."""
    return entries.where(F.col(key) > after).orderBy(key).limit(limit)


def head(entries: DataFrame) -> DataFrame:
    """The position that no later entry can precede: the last of the sealed entries."""
    return entries.agg(F.coalesce(F.max("position"), F.lit("0" * 32)).alias("head"))


def state_as_of(entries: DataFrame, at: str) -> DataFrame:
    """Each document's last kind at a position, and whether later entries put the reader behind."""
    seen = F.col("position") <= at
    return entries.groupBy("document_uid").agg(
        F.max_by("kind", F.when(seen, F.col("position"))).alias("kind"),
        F.max(F.when(seen, F.col("position"))).alias("position"),
        F.coalesce(F.max("position") > at, F.lit(False)).alias("behind"),
    )


def forward_only(reports: DataFrame, key: str, order: str, value: str, ahead: Column) -> DataFrame:
    """Cursor reports in order: recorded, backwards (with the recorded value) or ahead of the head."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    recorded = F.max(F.when(~ahead, F.col(value))).over(before)
    verdict = F.when(ahead, "ahead_of_head").when(F.col(value) < recorded, "backwards").otherwise("recorded")
    return reports.withColumn("recorded_before", recorded).withColumn("verdict", verdict)


@query("feed_positions", f"WITH {FEED_SQL} SELECT position, occurred_us, event_id, position = printf('%016x', occurred_us) || printf('%016x', event_id) AS round_trip FROM feed")
def feed_positions(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d)
    major, minor = decode_position(F.col("position"))
    return f.select("position", major.alias("occurred_us"), minor.alias("event_id"), (F.concat(hex16(major), hex16(minor)) == F.col("position")).alias("round_trip"))


@query("feed_page", f"WITH {FEED_SQL}, c AS (SELECT position AS cur FROM feed ORDER BY position LIMIT 1 OFFSET 1000) SELECT position, kind, document_uid FROM feed, c WHERE position > cur ORDER BY position LIMIT 200")
def feed_page(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d)
    cursor = f.select("position").orderBy("position").offset(1000).limit(1)
    # the cursor is one row
    return page(f.join(F.broadcast(cursor.withColumnRenamed("position", "cur"))).where("position > cur"), "", 200).select("position", "kind", "document_uid")


@query("feed_head", f"WITH {FEED_SQL} SELECT max(position) AS head FROM feed")
def feed_head(spark: SparkSession, d: str) -> DataFrame:
    return head(feed(spark, d))


@query("feed_uid_page", f"WITH {FEED_SQL}, u AS (SELECT DISTINCT document_uid FROM feed WHERE document_uid > 'doc_1'), p AS (SELECT * FROM u ORDER BY 1 LIMIT 51) SELECT document_uid, (SELECT count(*) FROM p) > 50 AS has_next FROM (SELECT * FROM p ORDER BY 1 LIMIT 50)")
def feed_uid_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of ids with one row of look-ahead: a full page has a next one."""
    ahead = page(feed(spark, d).select("document_uid").distinct(), "doc_1", 51, "document_uid")
    ranked = ahead.withColumn("n", F.count("*").over(Window.partitionBy())).withColumn("k", F.row_number().over(Window.orderBy("document_uid")))
    return ranked.where("k <= 50").select("document_uid", (F.col("n") > 50).alias("has_next"))


@query(
    "feed_composite_page",
    f"WITH {FEED_SQL}, k AS (SELECT source_id, document_uid, max(value) AS top FROM feed GROUP BY 1, 2), p AS (SELECT * FROM k WHERE (source_id, document_uid) > (3, 'doc_23') ORDER BY 1, 2 LIMIT 40) SELECT source_id, document_uid, round(top, 6) AS top FROM p WHERE top > 50",
)
def feed_composite_page(spark: SparkSession, d: str) -> DataFrame:
    """Page by a composite key first, filter after: a filter must not change where pages end."""
    k = feed(spark, d).groupBy("source_id", "document_uid").agg(F.max("value").alias("top"))
    after = (F.col("source_id") > 3) | ((F.col("source_id") == 3) & (F.col("document_uid") > "doc_23"))
    return k.where(after).orderBy("source_id", "document_uid").limit(40).where("top > 50").select("source_id", "document_uid", F.round("top", 6).alias("top"))


@query("page_tokens", "SELECT DISTINCT c_mktsegment || '/' || c_nationkey || '/x' AS token, c_mktsegment AS before, c_nationkey || '/x' AS after FROM customer")
def page_tokens(spark: SparkSession, d: str) -> DataFrame:
    """A token splits at its first '/' only."""
    token = F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string"), F.lit("x"))
    t = load(spark, d, "customer").select(token.alias("token")).distinct()
    return t.select("token", F.substring_index("token", "/", 1).alias("before"), F.expr("substring(token, instr(token, '/') + 1)").alias("after"))


@query(
    "feed_state_as_of",
    f"WITH {FEED_SQL}, cut AS (SELECT quantile_disc(position, 0.5) AS p FROM feed), s AS (SELECT document_uid, max(position) FILTER (position <= p) AS position, max(position) > any_value(p) AS behind FROM feed, cut GROUP BY 1) SELECT s.document_uid, f.kind, s.position, s.behind FROM s LEFT JOIN feed f ON f.position = s.position",
)
def feed_state_as_of(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d)
    n = f.count()
    at = f.select("position").orderBy("position").offset(max(0, -(-n // 2) - 1)).limit(1).first()
    return state_as_of(f, at["position"] if at else "")


@query(
    "feed_cursor_reports",
    f"""WITH {FEED_SQL}, r AS (SELECT source_id, event_id, CAST(value * 100 AS BIGINT) AS claim FROM feed WHERE kind = 'view'),
    x AS (SELECT *, max(CASE WHEN claim <= 9000 THEN claim END) OVER (PARTITION BY source_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS recorded_before FROM r)
    SELECT source_id, event_id, claim, recorded_before, CASE WHEN claim > 9000 THEN 'ahead_of_head' WHEN claim < recorded_before THEN 'backwards' ELSE 'recorded' END AS verdict FROM x""",
)
def feed_cursor_reports(spark: SparkSession, d: str) -> DataFrame:
    r = feed(spark, d).where("kind = 'view'").select("source_id", "event_id", F.round(F.col("value") * 100).cast("long").alias("claim"))
    return forward_only(r, "source_id", "event_id", "claim", F.col("claim") > 9000)


@query(
    "feed_retention",
    f"WITH {FEED_SQL}, w AS (SELECT position, occurred_us, (occurred_us // 86400000000) // 7 AS part FROM feed), l AS (SELECT max(part) - 2 AS keep FROM w) SELECT part, count(*) AS entries, part < any_value(keep) AS dropped, CASE WHEN part < any_value(keep) THEN max(position) END AS horizon FROM w, l GROUP BY part",
)
def feed_retention(spark: SparkSession, d: str) -> DataFrame:
    """Whole partitions (here weeks) older than the kept ones are dropped; each raises the horizon to its last position."""
    w = feed(spark, d).select("position", F.floor(F.floor(F.col("occurred_us") / DAY_US) / 7).alias("part"))
    last = F.broadcast(w.agg((F.max("part") - 2).alias("keep")))
    parts = w.groupBy("part").agg(F.count("*").alias("entries"), F.max("position").alias("top")).join(last)
    gone = F.col("part") < F.col("keep")
    return parts.select("part", "entries", gone.alias("dropped"), F.when(gone, F.col("top")).alias("horizon"))


@query(
    "feed_cursor_expiry",
    f"WITH {FEED_SQL}, h AS (SELECT quantile_disc(position, 0.25) AS horizon FROM feed), c AS (SELECT source_id, min(position) AS cur FROM feed GROUP BY 1) SELECT source_id, cur, CASE WHEN cur < horizon THEN 'CURSOR_EXPIRED' ELSE 'OK' END AS verdict FROM c, h",
)
def feed_cursor_expiry(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d)
    n = f.count()
    at = f.select("position").orderBy("position").offset(max(0, -(-n // 4) - 1)).limit(1).first()
    cursors = f.groupBy("source_id").agg(F.min("position").alias("cur"))
    return cursors.select("source_id", "cur", F.when(F.col("cur") < F.lit(at["position"] if at else ""), "CURSOR_EXPIRED").otherwise("OK").alias("verdict"))


@query(
    "feed_profile_changes",
    f"WITH {FEED_SQL}, x AS (SELECT source_id, position, kind, lag(kind) OVER (PARTITION BY source_id ORDER BY position) AS prev FROM feed) SELECT source_id, position AS profile_seq, kind AS profile FROM x WHERE prev IS DISTINCT FROM kind",
)
def feed_profile_changes(spark: SparkSession, d: str) -> DataFrame:
    """A profile set to what it was appends nothing; a change takes the entry's position."""
    prev = F.lag("kind").over(Window.partitionBy("source_id").orderBy("position"))
    f = feed(spark, d).withColumn("prev", prev)
    return f.where(~F.col("prev").eqNullSafe(F.col("kind"))).select("source_id", F.col("position").alias("profile_seq"), F.col("kind").alias("profile"))


@query(
    "feed_bootstrap",
    f"WITH {FEED_SQL}, h AS (SELECT max(position) AS head FROM feed) SELECT source_id, document_uid, max(position) AS newest, max(position) <= any_value(head) AS covered FROM feed, h GROUP BY 1, 2",
)
def feed_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """The head is read first, then Sources and documents: all that is listed is covered by a read from the head."""
    f = feed(spark, d)
    return f.groupBy("source_id", "document_uid").agg(F.max("position").alias("newest")).join(F.broadcast(head(f))).select("source_id", "document_uid", "newest", (F.col("newest") <= F.col("head")).alias("covered"))


@query(
    "feed_consumer_lag",
    f"WITH {FEED_SQL}, c AS (SELECT source_id, quantile_disc(occurred_us, 0.8) AS cur FROM feed GROUP BY 1), now AS (SELECT max(occurred_us) AS now FROM feed) SELECT c.source_id, count(f.event_id) AS behind, coalesce(any_value(now) - min(f.occurred_us), 0) AS lag_us FROM c CROSS JOIN now LEFT JOIN feed f ON f.source_id = c.source_id AND f.occurred_us > c.cur GROUP BY 1",
)
def feed_consumer_lag(spark: SparkSession, d: str) -> DataFrame:
    """Age of the first entry after each consumer's cursor, 0 when it has caught up."""
    f = feed(spark, d)
    w = Window.partitionBy("source_id")
    ranked = f.select("source_id", "occurred_us", F.row_number().over(w.orderBy("occurred_us")).alias("k"), F.count("*").over(w).alias("n"))
    cursor = ranked.withColumn("cur", F.max(F.when(F.col("k") == F.ceil(F.col("n") * F.lit(0.8)), F.col("occurred_us"))).over(w))
    now = F.broadcast(f.agg(F.max("occurred_us").alias("now")))
    after = F.col("occurred_us") > F.col("cur")
    out = cursor.groupBy("source_id").agg(F.count_if(after).alias("behind"), F.min(F.when(after, F.col("occurred_us"))).alias("first"))
    return out.join(now).select("source_id", "behind", F.coalesce(F.col("now") - F.col("first"), F.lit(0)).alias("lag_us"))


@query("feed_oldest_open", f"WITH {FEED_SQL}, n AS (SELECT max(occurred_us) AS now FROM feed) SELECT kind, max(now - occurred_us) AS oldest_us, count(*) AS open FROM feed, n GROUP BY 1")
def feed_oldest_open(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d)
    now = F.broadcast(f.agg(F.max("occurred_us").alias("now")))
    return f.join(now).groupBy("kind").agg(F.max(F.col("now") - F.col("occurred_us")).alias("oldest_us"), F.count("*").alias("open"))


@query(
    "feed_order_violations",
    f"WITH {FEED_SQL}, x AS (SELECT document_uid, CAST(value * 100 AS BIGINT) AS rev, max(CAST(value * 100 AS BIGINT)) OVER (PARTITION BY document_uid ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM feed) SELECT document_uid, count(*) FILTER (rev <= top) AS violations, count(*) AS entries FROM x GROUP BY 1",
)
def feed_order_violations(spark: SparkSession, d: str) -> DataFrame:
    """Entries whose revision does not exceed the largest one before, per document."""
    w = Window.partitionBy("document_uid").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    x = feed(spark, d).select("document_uid", "position", F.round(F.col("value") * 100).cast("long").alias("rev"))
    x = x.withColumn("top", F.max("rev").over(w))
    return x.groupBy("document_uid").agg(F.count_if(F.col("rev") <= F.col("top")).alias("violations"), F.count("*").alias("entries"))


@query(
    "feed_redelivery",
    f"""WITH {FEED_SQL}, x AS (SELECT *, sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY position) AS incarnation FROM feed),
    y AS (SELECT source_id, incarnation, value < lag(value) OVER w AS regressed, row_number() OVER (PARTITION BY source_id, incarnation, document_uid ORDER BY position) > 1 AS again FROM x WINDOW w AS (PARTITION BY source_id, incarnation ORDER BY position))
    SELECT source_id, CAST(incarnation AS BIGINT) AS incarnation, count(*) FILTER (regressed) AS regressions, count(*) FILTER (again) AS redelivered FROM y GROUP BY 1, 2""",
)
def feed_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """Regressions and redeliveries per incarnation; a marker entry starts a new one."""
    f = feed(spark, d).withColumn("incarnation", F.sum((F.col("kind") == "error").cast("long")).over(Window.partitionBy("source_id").orderBy("position")))
    w = Window.partitionBy("source_id", "incarnation").orderBy("position")
    again = F.row_number().over(Window.partitionBy("source_id", "incarnation", "document_uid").orderBy("position")) > 1
    y = f.select("source_id", "incarnation", (F.col("value") < F.lag("value").over(w)).alias("regressed"), again.alias("again"))
    return y.groupBy("source_id", "incarnation").agg(F.count_if("regressed").alias("regressions"), F.count_if("again").alias("redelivered"))


@query("feed_strictly_increasing", f"WITH {FEED_SQL}, x AS (SELECT source_id, position > lag(position) OVER (PARTITION BY source_id ORDER BY event_id) AS up FROM feed) SELECT source_id, coalesce(bool_and(up), true) AS increasing FROM x GROUP BY 1")
def feed_strictly_increasing(spark: SparkSession, d: str) -> DataFrame:
    up = F.col("position") > F.lag("position").over(Window.partitionBy("source_id").orderBy("event_id"))
    return feed(spark, d).select("source_id", up.alias("up")).groupBy("source_id").agg(F.coalesce(F.bool_and("up"), F.lit(True)).alias("increasing"))


@query(
    "feed_delivery_recon",
    f"WITH {FEED_SQL}, truth AS (SELECT event_id FROM feed WHERE event_id % 7 <> 0), got AS (SELECT event_id FROM feed WHERE event_id % 11 <> 0 UNION ALL SELECT event_id FROM feed WHERE event_id % 13 = 0), g AS (SELECT event_id, count(*) AS n FROM got GROUP BY 1) SELECT coalesce(t.event_id, g.event_id) AS event_id, CASE WHEN g.n IS NULL THEN 'missed' WHEN t.event_id IS NULL THEN 'unexpected' ELSE 'duplicated' END AS what, coalesce(g.n, 0) AS deliveries FROM truth t FULL JOIN g USING (event_id) WHERE g.n IS NULL OR t.event_id IS NULL OR g.n > 1",
)
def feed_delivery_recon(spark: SparkSession, d: str) -> DataFrame:
    """What was delivered against the truth: missed, unexpected and duplicated, in one full outer join."""
    e = feed(spark, d).select("event_id")
    truth = e.where("event_id % 7 <> 0").withColumn("true", F.lit(True))
    got = e.where("event_id % 11 <> 0").union(e.where("event_id % 13 = 0")).groupBy("event_id").agg(F.count("*").alias("n"))
    both = truth.join(got, "event_id", "full")
    what = F.when(F.col("n").isNull(), "missed").when(F.col("true").isNull(), "unexpected").when(F.col("n") > 1, "duplicated")
    return both.select("event_id", what.alias("what"), F.coalesce("n", F.lit(0)).alias("deliveries")).where("what is not null")


@query(
    "feed_xor_digest",
    f"WITH {FEED_SQL}, x AS (SELECT source_id, sha256(position || ':' || kind) AS h FROM feed) SELECT source_id, count(*) AS entries, bit_xor(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS high, bit_xor(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS low FROM x GROUP BY 1",
)
def feed_xor_digest(spark: SparkSession, d: str) -> DataFrame:
    """An order-free digest of a set: xor over its entries' hashes, in two signed halves of 60 bits."""
    h = F.sha2(F.concat_ws(":", "position", "kind"), 256)
    x = feed(spark, d).select("source_id", h.alias("h"))
    half = [F.bit_xor(F.conv(F.substring("h", a, 15), 16, 10).cast("long")) for a in (1, 16)]
    return x.groupBy("source_id").agg(F.count("*").alias("entries"), half[0].alias("high"), half[1].alias("low"))


@query(
    "feed_store_extras",
    f"WITH {FEED_SQL} SELECT DISTINCT document_uid FROM feed WHERE kind = 'view' AND document_uid NOT IN (SELECT document_uid FROM feed WHERE kind = 'purchase') UNION SELECT DISTINCT 'listed_' || source_id FROM feed",
)
def feed_store_extras(spark: SparkSession, d: str) -> DataFrame:
    """What a store holds beyond the enumeration, with the listed names of the Sources."""
    f = feed(spark, d)
    extras = f.where("kind = 'view'").select("document_uid").distinct().join(f.where("kind = 'purchase'").select("document_uid"), "document_uid", "left_anti")
    return extras.union(f.select(F.concat(F.lit("listed_"), F.col("source_id").cast("string"))).distinct()).distinct()


@query("feed_snapshot_row", f"WITH {FEED_SQL} SELECT w.document_uid, any_value(f.kind) IS NOT NULL AS known, count(f.event_id) AS entries FROM (SELECT 'doc_1' AS document_uid UNION ALL SELECT 'doc_none') w LEFT JOIN feed f USING (document_uid) GROUP BY 1")
def feed_snapshot_row(spark: SparkSession, d: str) -> DataFrame:
    """A read of one document always gives its row, known or not."""
    wanted = spark.createDataFrame([("doc_1",), ("doc_none",)], "document_uid string")
    counted = feed(spark, d).groupBy("document_uid").agg(F.count("*").alias("n"))
    return wanted.join(counted, "document_uid", "left").select("document_uid", F.col("n").isNotNull().alias("known"), F.coalesce("n", F.lit(0)).alias("entries"))


@query(
    "epoch_positions",
    "SELECT event_id, lpad(CAST(event_id % 7 AS VARCHAR), 6, '0') || '.' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS derived FROM events",
)
def epoch_positions(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-width decimal epoch and sequence: text order is (epoch, sequence) order."""
    return load(spark, d, "events").select("event_id", F.concat(F.lpad((F.col("event_id") % 7).cast("string"), 6, "0"), F.lit("."), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("derived"))


@query(
    "fenced_writers",
    f"WITH {FEED_SQL}, x AS (SELECT event_id, event_id % 50 AS epoch, occurred_us FROM feed), a AS (SELECT epoch, min(occurred_us) AS acquired FROM x GROUP BY 1) SELECT x.event_id, x.epoch, x.occurred_us - a.acquired AS late_us FROM x JOIN a ON a.epoch = x.epoch + 1 WHERE x.occurred_us > a.acquired",
)
def fenced_writers(spark: SparkSession, d: str) -> DataFrame:
    """Entries that an epoch wrote after the next one was acquired."""
    x = feed(spark, d).select("event_id", (F.col("event_id") % 50).alias("epoch"), "occurred_us")
    a = x.groupBy((F.col("epoch") - 1).alias("epoch")).agg(F.min("occurred_us").alias("acquired"))
    return x.join(a, "epoch").where("occurred_us > acquired").select("event_id", "epoch", (F.col("occurred_us") - F.col("acquired")).alias("late_us"))


@query(
    "takeover_latency",
    f"WITH {FEED_SQL}, x AS (SELECT event_id // 100 AS epoch, occurred_us FROM feed), e AS (SELECT epoch, max(occurred_us) AS fault, min(occurred_us) AS first FROM x GROUP BY 1) SELECT e.epoch, n.first - e.fault AS takeover_us FROM e JOIN e n ON n.epoch = e.epoch + 1",
)
def takeover_latency(spark: SparkSession, d: str) -> DataFrame:
    x = feed(spark, d).groupBy(F.floor(F.col("event_id") / 100).alias("epoch")).agg(F.max("occurred_us").alias("fault"), F.min("occurred_us").alias("first"))
    nxt = x.select((F.col("epoch") - 1).alias("epoch"), F.col("first").alias("next"))
    return x.join(nxt, "epoch").select("epoch", (F.col("next") - F.col("fault")).alias("takeover_us"))


@query(
    "acknowledgement_gaps",
    f"""WITH {FEED_SQL}, w AS (SELECT s AS fault, s + 43200000000 AS until FROM (SELECT min(occurred_us) + k * 172800000000 AS s FROM feed, range(1, 10) r(k) GROUP BY k)),
    acks AS (SELECT occurred_us AS t FROM feed WHERE kind = 'signup'),
    p AS (SELECT w.fault, a.t FROM w JOIN acks a ON a.t > w.fault AND a.t <= w.until UNION ALL SELECT w.fault, max(a.t) FROM w JOIN acks a ON a.t <= w.fault GROUP BY 1),
    g AS (SELECT fault, t - lag(t) OVER (PARTITION BY fault ORDER BY t) AS gap FROM p) SELECT fault, coalesce(max(gap), 0) AS longest_us FROM g GROUP BY 1""",
)
def acknowledgement_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The longest gap between acknowledgements in each fault window; the last one before the fault starts it.

    Windows are a small parameter list, so acknowledgements are tagged with their windows rather than joined by range.
    """
    f = feed(spark, d)
    start = f.agg(F.min("occurred_us")).first()[0]
    faults = [start + k * 2 * DAY_US for k in range(1, 10)]
    windows = F.array(*[F.when(F.col("t") <= x + DAY_US // 2, F.struct(F.lit(x).alias("fault"), (F.col("t") <= x).alias("before"))) for x in faults])
    acks = f.where("kind = 'signup'").select(F.col("occurred_us").alias("t"))
    tagged = acks.select("t", F.explode(F.array_compact(windows)).alias("w")).select("w.fault", "w.before", "t")
    last = tagged.where("before").groupBy("fault").agg(F.max("t").alias("t"))
    points = tagged.where("not before").select("fault", "t").union(last.select("fault", "t"))
    gaps = points.withColumn("gap", F.col("t") - F.lag("t").over(Window.partitionBy("fault").orderBy("t")))
    return gaps.groupBy("fault").agg(F.coalesce(F.max("gap"), F.lit(0)).alias("longest_us"))
