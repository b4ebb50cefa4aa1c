"""Submissions, requests, dispatch, adoption and authorization: record semantics as folds and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions import rules
from quillfold.functions.codecs import custody_key, percent_encoded
from quillfold.registry import query
from quillfold.sources.tables import FEED_SQL, ITEMS_SQL, REQUESTS_SQL, feed, items, load, requests

NOW_SQL = "now AS (SELECT max(created_day) + 1 AS today FROM requests)"


def newest(df: DataFrame, key: str, *order) -> DataFrame:
    """Top one a key: Spark keeps a row a key and task before it shuffles (WindowGroupLimit)."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_k = 1").drop("_k")


def today(r: DataFrame) -> DataFrame:
    return F.broadcast(r.agg((F.max("created_day") + 1).alias("today")))  # one row


@query(
    "request_attention",
    f"""WITH {REQUESTS_SQL}, {NOW_SQL}, l AS (SELECT * FROM requests QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY created_day DESC, request_id DESC) = 1)
    SELECT c.c_custkey AS document_id, l.request_id, l.state,
      CASE WHEN l.request_id IS NULL THEN 'not_ready' WHEN l.state = 'ended' THEN 'ready' ELSE 'ready_stale' END AS readiness,
      CASE WHEN l.state <> 'ended' AND today - l.created_day > 90 THEN 'stalled' WHEN l.state = 'ended' AND l.cost > 300000 THEN 'failed' ELSE '' END AS attention
    FROM customer c LEFT JOIN l ON l.document_id = c.c_custkey CROSS JOIN now""",
)
def request_attention(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its newest request, readiness and what needs attention."""
    r = requests(spark, d)
    last = newest(r, "document_id", F.desc("created_day"), F.desc("request_id"))
    docs = load(spark, d, "customer").select(F.col("c_custkey").alias("document_id"))
    active = F.coalesce(F.col("state") != "ended", F.lit(False))
    failed = F.coalesce((F.col("state") == "ended") & (F.col("cost") > 300000), F.lit(False))
    stalled = F.coalesce(F.col("today") - F.col("created_day") > 90, F.lit(False))
    ready = F.when(F.col("request_id").isNull(), "not_ready").when(active, "ready_stale").otherwise("ready")
    return docs.join(last, "document_id", "left").join(today(r)).select("document_id", "request_id", "state", ready.alias("readiness"), F.array_join(rules.attention(F.lit(False), failed, active, stalled), ",").alias("attention"))


@query("latest_request", f"WITH {REQUESTS_SQL} SELECT document_id, request_id, state, priority FROM requests QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY created_day DESC, request_id DESC) = 1")
def latest_request(spark: SparkSession, d: str) -> DataFrame:
    return newest(requests(spark, d), "document_id", F.desc("created_day"), F.desc("request_id")).select("document_id", "request_id", "state", "priority")


@query("latest_failed_request", f"WITH {REQUESTS_SQL} SELECT document_id, max(request_id) AS failed, count(*) AS failures FROM requests WHERE state = 'ended' AND cost > 200000 GROUP BY 1")
def latest_failed_request(spark: SparkSession, d: str) -> DataFrame:
    return requests(spark, d).where("state = 'ended' and cost > 200000").groupBy("document_id").agg(F.max_by("request_id", "request_id").alias("failed"), F.count("*").alias("failures"))


@query(
    "visible_requests",
    f"WITH {REQUESTS_SQL}, {NOW_SQL} SELECT r.request_id, c.c_custkey AS document_id, c.c_nationkey AS tenant FROM requests r JOIN customer c ON c.c_custkey = r.document_id, now WHERE r.state <> 'ended' OR today - created_day <= 30",
)
def visible_requests(spark: SparkSession, d: str) -> DataFrame:
    """Active requests, and ended ones for a while, with their owner's tenant."""
    r = requests(spark, d)
    own = load(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), F.col("c_nationkey").alias("tenant"))
    seen = (F.col("state") != "ended") | (F.col("today") - F.col("created_day") <= rules.VISIBLE_DAYS)
    return r.join(today(r)).where(seen).join(own, "document_id").select("request_id", "document_id", "tenant")


@query("in_flight_by_source", f"WITH {REQUESTS_SQL} SELECT c_nationkey AS tenant, c_mktsegment AS source, count(*) AS in_flight FROM requests r JOIN customer ON c_custkey = document_id WHERE state = 'processing' GROUP BY ROLLUP (c_nationkey, c_mktsegment)")
def in_flight_by_source(spark: SparkSession, d: str) -> DataFrame:
    """In-flight counts by Source, by tenant and in all."""
    own = load(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), F.col("c_nationkey").alias("tenant"), F.col("c_mktsegment").alias("source"))
    return requests(spark, d).where("state = 'processing'").join(own, "document_id").rollup("tenant", "source").agg(F.count("*").alias("in_flight"))


@query("normal_backlog", f"WITH {REQUESTS_SQL} SELECT count(*) FILTER (state = 'queued' AND priority = 'normal') AS backlog, count(*) FILTER (state = 'queued' AND priority = 'normal') >= 1000 AS paused FROM requests")
def normal_backlog(spark: SparkSession, d: str) -> DataFrame:
    n = F.count_if((F.col("state") == "queued") & (F.col("priority") == "normal"))
    return requests(spark, d).agg(n.alias("backlog"), (n >= 1000).alias("paused"))


FAIR_SQL = f"""WITH {REQUESTS_SQL}, f AS (SELECT document_id % 97 AS source, count(*) AS n FROM requests WHERE state = 'processing' GROUP BY 1),
    q AS (SELECT r.*, r.document_id % 97 AS source, coalesce(f.n, 0) AS in_flight FROM requests r LEFT JOIN f ON f.source = r.document_id % 97 WHERE state = 'queued'),
    t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority = 'low', created_day, request_id) AS turn FROM q)"""


def fair(spark: SparkSession, d: str) -> DataFrame:
    """Queued requests with their Source's in-flight count and their turn in it."""
    r = requests(spark, d).withColumn("source", F.col("document_id") % 97)
    busy = r.where("state = 'processing'").groupBy("source").agg(F.count("*").alias("n"))
    q = r.where("state = 'queued'").join(busy, "source", "left").withColumn("in_flight", F.coalesce("n", F.lit(0)))
    return q.withColumn("turn", F.row_number().over(Window.partitionBy("source").orderBy(F.col("priority") == "low", "created_day", "request_id")))


@query("fair_claim_order", FAIR_SQL + " SELECT request_id, source, in_flight, CAST(turn AS INTEGER) AS turn FROM t ORDER BY priority = 'low', in_flight + turn, created_day, request_id LIMIT 500")
def fair_claim_order(spark: SparkSession, d: str) -> DataFrame:
    """Low priority last, then the Source with the fewest in flight (its earlier turns counted), then the oldest."""
    return fair(spark, d).orderBy(F.col("priority") == "low", F.col("in_flight") + F.col("turn"), "created_day", "request_id").limit(500).select("request_id", "source", "in_flight", "turn")


@query("dispatch_budgets", FAIR_SQL + " SELECT request_id, source FROM t WHERE in_flight + turn <= 60 ORDER BY priority = 'low', in_flight + turn, created_day, request_id LIMIT 1000")
def dispatch_budgets(spark: SparkSession, d: str) -> DataFrame:
    """What one dispatch starts: within each Source's budget, then the fair order up to the global one."""
    return fair(spark, d).where("in_flight + turn <= 60").orderBy(F.col("priority") == "low", F.col("in_flight") + F.col("turn"), "created_day", "request_id").limit(1000).select("request_id", "source")


@query("outbox_claims", f"WITH {REQUESTS_SQL} SELECT r.request_id, n.n_name AS tenant, r.priority, i.files FROM requests r JOIN customer c ON c.c_custkey = r.document_id JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN (SELECT l_orderkey, count(*) AS files FROM lineitem GROUP BY 1) i ON i.l_orderkey = r.request_id WHERE r.state = 'queued'")
def outbox_claims(spark: SparkSession, d: str) -> DataFrame:
    """Due requests with owner, tenant and number of files: a multiway join whose dimensions Spark broadcasts by size."""
    own = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("document_id"), F.col("n_name").alias("tenant"))
    files = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("request_id")).agg(F.count("*").alias("files"))
    return requests(spark, d).where("state = 'queued'").join(own, "document_id").join(files, "request_id").select("request_id", "tenant", "priority", "files")


@query("backoff_schedule", "SELECT event_id, event_id % 40 AS attempts, least(60.0, pow(2.0, least(event_id % 40, 30))) AS seconds FROM events")
def backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    attempts = F.col("event_id") % 40
    return load(spark, d, "events").select("event_id", attempts.alias("attempts"), rules.backoff_seconds(attempts).alias("seconds"))


EFFECTIVE_SQL = f"""WITH {ITEMS_SQL}, {REQUESTS_SQL}, e AS (SELECT i.batch_id, i.idx, CASE WHEN i.status = 'queued' AND r.state IS NOT NULL THEN r.state WHEN i.status = 'declared' AND i.day < 9500 THEN 'expired' ELSE i.status END AS status FROM items i LEFT JOIN requests r ON r.request_id = i.batch_id)"""


def effective(spark: SparkSession, d: str) -> DataFrame:
    r = requests(spark, d).select(F.col("request_id").alias("batch_id"), "state")
    i = items(spark, d).join(r, "batch_id", "left")
    return i.select("batch_id", "idx", rules.effective_status(F.col("status"), F.col("state"), F.col("day") < 9500).alias("status"))


@query("effective_items", EFFECTIVE_SQL + " SELECT * FROM e")
def effective_items(spark: SparkSession, d: str) -> DataFrame:
    return effective(spark, d)


@query("batch_counts", EFFECTIVE_SQL + " SELECT batch_id, string_agg(status || '=' || n, ',' ORDER BY status) AS counts FROM (SELECT batch_id, status, count(*) AS n FROM e GROUP BY 1, 2) GROUP BY 1")
def batch_counts(spark: SparkSession, d: str) -> DataFrame:
    """Items of each batch by effective status, as one text."""
    n = effective(spark, d).groupBy("batch_id", "status").agg(F.count("*").alias("n"))
    pair = F.concat_ws("=", "status", F.col("n").cast("string"))
    return n.groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("counts"))


@query("items_decided", EFFECTIVE_SQL + " SELECT status, batch_id % 5 AS operation, count(*) AS items FROM e GROUP BY 1, 2")
def items_decided(spark: SparkSession, d: str) -> DataFrame:
    return effective(spark, d).groupBy("status", (F.col("batch_id") % 5).alias("operation")).agg(F.count("*").alias("items"))


@query("all_rejected", f"WITH {ITEMS_SQL} SELECT batch_id, count(*) AS items FROM items GROUP BY 1 HAVING bool_and(status = 'rejected')")
def all_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Batches of which nothing is kept."""
    return items(spark, d).groupBy("batch_id").agg(F.count("*").alias("items"), F.bool_and(F.col("status") == "rejected").alias("gone")).where("gone").drop("gone")


@query("duplicate_items", f"WITH {ITEMS_SQL} SELECT batch_id, idx, document_id FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, document_id % 20 ORDER BY idx, document_id, path, size) AS k FROM items) WHERE k > 1")
def duplicate_items(spark: SparkSession, d: str) -> DataFrame:
    """All but the first item of an id within a request."""
    k = F.row_number().over(Window.partitionBy("batch_id", F.col("document_id") % 20).orderBy("idx", "document_id", "path", "size"))
    return items(spark, d).withColumn("k", k).where("k > 1").select("batch_id", "idx", "document_id")


DECLARE_SQL = """CASE WHEN k > 1 THEN 'DUPLICATE' WHEN NOT regexp_matches(path, '^[a-z0-9/]+\\.pdf$') OR size < 1 THEN 'STRUCTURE' WHEN size > 45 THEN 'FORMAT'
    WHEN document_id % 31 = 0 THEN 'VERSION' WHEN state IS NULL THEN 'BINDING' WHEN document_id % 17 = 0 THEN 'PLACEMENT' WHEN day < 9300 THEN 'STALE' END"""


@query("declare_cascade", f"WITH {ITEMS_SQL}, {REQUESTS_SQL}, x AS (SELECT i.*, r.state, row_number() OVER (PARTITION BY i.batch_id, i.document_id % 20 ORDER BY idx, i.document_id, path, size) AS k FROM items i LEFT JOIN requests r ON r.request_id = i.document_id) SELECT batch_id, idx, {DECLARE_SQL} AS reason FROM x")
def declare_cascade(spark: SparkSession, d: str) -> DataFrame:
    """The first rule that an item breaks: duplicate, structure, format, version, binding, placement, order."""
    k = F.row_number().over(Window.partitionBy("batch_id", F.col("document_id") % 20).orderBy("idx", "document_id", "path", "size"))
    known = requests(spark, d).select(F.col("request_id").alias("document_id"), "state")
    x = items(spark, d).withColumn("k", k).join(known, "document_id", "left")
    reason = rules.first_failure(
        (F.col("k") > 1, "DUPLICATE"),
        (~F.col("path").rlike(r"^[a-z0-9/]+\.pdf$") | (F.col("size") < 1), "STRUCTURE"),
        (F.col("size") > 45, "FORMAT"),
        (F.col("document_id") % 31 == 0, "VERSION"),
        (F.col("state").isNull(), "BINDING"),
        (F.col("document_id") % 17 == 0, "PLACEMENT"),
        (F.col("day") < 9300, "STALE"),
    )
    return x.select("batch_id", "idx", reason.alias("reason"))


@query("finalize_cascade", f"WITH {ITEMS_SQL}, {REQUESTS_SQL} SELECT i.batch_id, i.idx, CASE WHEN r.state = 'ended' AND r.cost < 50000 THEN 'DELETED' WHEN i.day < 9300 THEN 'STALE' WHEN i.document_id % 13 = 0 THEN 'RESOURCE' WHEN i.size % 9 = 0 THEN 'FILES' WHEN i.size > 45 THEN 'FORMAT' WHEN i.idx > 6 THEN 'ORDER' END AS reason FROM items i LEFT JOIN requests r ON r.request_id = i.batch_id WHERE i.status = 'declared'")
def finalize_cascade(spark: SparkSession, d: str) -> DataFrame:
    r = requests(spark, d).select(F.col("request_id").alias("batch_id"), "state", "cost")
    x = items(spark, d).where("status = 'declared'").join(r, "batch_id", "left")
    reason = rules.first_failure(
        ((F.col("state") == "ended") & (F.col("cost") < 50000), "DELETED"),
        (F.col("day") < 9300, "STALE"),
        (F.col("document_id") % 13 == 0, "RESOURCE"),
        (F.col("size") % 9 == 0, "FILES"),
        (F.col("size") > 45, "FORMAT"),
        (F.col("idx") > 6, "ORDER"),
    )
    return x.select("batch_id", "idx", reason.alias("reason"))


@query(
    "version_order_rule",
    f"""WITH {ITEMS_SQL}, x AS (SELECT batch_id, idx, CASE WHEN size % 5 = 0 THEN 'v' || size ELSE CAST(size AS VARCHAR) END AS v, document_id % 3 = 0 AS same, status = 'rejected' AS rejected FROM items),
    y AS (SELECT *, lag(v) OVER (PARTITION BY batch_id ORDER BY idx, same, rejected, v) AS o FROM x),
    z AS (SELECT *, CASE WHEN regexp_full_match(v, '[0-9]{{1,18}}') THEN CAST(v AS BIGINT) END AS nv, CASE WHEN regexp_full_match(o, '[0-9]{{1,18}}') THEN CAST(o AS BIGINT) END AS ov FROM y)
    SELECT batch_id, idx, CASE WHEN ov IS NULL AND nv IS NOT NULL THEN 'none' WHEN nv IS NULL THEN 'INVALID' WHEN same AND nv >= ov THEN 'same' WHEN nv > ov THEN 'newer' WHEN nv < ov THEN 'STALE' WHEN rejected THEN 'newer' ELSE 'CONFLICT' END AS verdict FROM z""",
)
def version_order_rule(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("size") % 5 == 0, F.concat(F.lit("v"), F.col("size").cast("string"))).otherwise(F.col("size").cast("string"))
    x = items(spark, d).withColumn("v", text)
    x = x.withColumns({"same": F.col("document_id") % 3 == 0, "rejected": F.col("status") == "rejected"})
    x = x.withColumn("o", F.lag("v").over(Window.partitionBy("batch_id").orderBy("idx", "same", "rejected", "v")))
    x = x.withColumns({"new": rules.version(F.col("v")), "old": rules.version(F.col("o"))})
    return x.select("batch_id", "idx", rules.order_rule(F.col("new"), F.col("old"), F.col("same"), F.col("rejected")).alias("verdict"))


@query(
    "same_content",
    "WITH x AS (SELECT doc_id, source, sha256(text) AS sha, lag(sha256(text)) OVER (PARTITION BY source ORDER BY doc_id) AS prev FROM documents) SELECT doc_id, CASE WHEN prev IS NULL THEN 'new' WHEN sha = prev THEN CASE WHEN doc_id % 3 = 0 THEN 'active' WHEN doc_id % 3 = 1 THEN 'retry' ELSE 'unchanged' END ELSE 'changed' END AS resolution FROM x",
)
def same_content(spark: SparkSession, d: str) -> DataFrame:
    """Equal content resolves to the active request, a retry of a failed one, or no change."""
    sha = F.sha2("text", 256)
    x = load(spark, d, "documents").select("doc_id", "source", sha.alias("sha"))
    x = x.withColumn("prev", F.lag("sha").over(Window.partitionBy("source").orderBy("doc_id")))
    same = F.when(F.col("doc_id") % 3 == 0, "active").when(F.col("doc_id") % 3 == 1, "retry").otherwise("unchanged")
    return x.select("doc_id", F.when(F.col("prev").isNull(), "new").when(F.col("sha") == F.col("prev"), same).otherwise("changed").alias("resolution"))


@query(
    "content_sets_equal",
    f"WITH {ITEMS_SQL}, f AS (SELECT batch_id, list_sort(list(path || ':' || size)) AS files FROM items GROUP BY 1) SELECT a.batch_id, a.files = b.files AS same, len(a.files) AS n_files FROM f a JOIN f b ON b.batch_id = a.batch_id + 1",
)
def content_sets_equal(spark: SparkSession, d: str) -> DataFrame:
    """Content is the set of (path, digest) pairs, whatever their order."""
    f = items(spark, d).groupBy("batch_id").agg(F.array_sort(F.collect_list(F.concat_ws(":", "path", F.col("size").cast("string")))).alias("files"))
    nxt = f.select((F.col("batch_id") - 1).alias("batch_id"), F.col("files").alias("next"))
    return f.join(nxt, "batch_id").select("batch_id", (F.col("files") == F.col("next")).alias("same"), F.size("files").cast("long").alias("n_files"))


@query(
    "catalog_merge",
    f"WITH {FEED_SQL}, x AS (SELECT document_uid, position, CASE WHEN kind = 'view' THEN 't' || event_id END AS title, CASE WHEN kind = 'click' THEN 'u' || event_id END AS url FROM feed) SELECT document_uid, arg_max(title, position) FILTER (title IS NOT NULL) AS title, arg_max(url, position) FILTER (url IS NOT NULL) AS url FROM x GROUP BY 1",
)
def catalog_merge(spark: SparkSession, d: str) -> DataFrame:
    """Of each catalog field the last value given; what is omitted keeps."""
    title = F.when(F.col("kind") == "view", F.concat(F.lit("t"), F.col("event_id").cast("string")))
    url = F.when(F.col("kind") == "click", F.concat(F.lit("u"), F.col("event_id").cast("string")))
    x = feed(spark, d).select("document_uid", "position", title.alias("title"), url.alias("url"))
    return x.groupBy("document_uid").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("position"))).alias(c) for c in ("title", "url")])


@query("recorded_version_raise", f"WITH {FEED_SQL} SELECT document_uid, max(CAST(round(value * 100) AS BIGINT)) AS recorded, count(*) AS submissions FROM feed WHERE kind <> 'error' GROUP BY 1")
def recorded_version_raise(spark: SparkSession, d: str) -> DataFrame:
    """A higher version of the same content raises the recorded one; lower ones leave it."""
    return feed(spark, d).where("kind <> 'error'").groupBy("document_uid").agg(F.max(F.round(F.col("value") * 100).cast("long")).alias("recorded"), F.count("*").alias("submissions"))


@query(
    "idempotent_replay",
    f"WITH {FEED_SQL}, x AS (SELECT event_id, document_uid AS key, kind AS body, occurred_us FROM feed), y AS (SELECT *, first_value(body) OVER w AS first_body, first_value(event_id) OVER w AS first_id FROM x WINDOW w AS (PARTITION BY key, occurred_us // 86400000000 ORDER BY event_id)) SELECT event_id, key, CASE WHEN event_id = first_id THEN 'stored' WHEN body = first_body THEN 'replayed' ELSE 'mismatch' END AS verdict FROM y",
)
def idempotent_replay(spark: SparkSession, d: str) -> DataFrame:
    """A key's first body in its day is stored; the same body is replayed, another is refused."""
    f = feed(spark, d).withColumn("day", F.floor(F.col("occurred_us") / 86_400_000_000))
    w = Window.partitionBy("document_uid", "day").orderBy("event_id")
    x = f.select("event_id", F.col("document_uid").alias("key"), "kind", F.first("kind").over(w).alias("body"), F.first("event_id").over(w).alias("first"))
    return x.select("event_id", "key", F.when(F.col("event_id") == F.col("first"), "stored").when(F.col("kind") == F.col("body"), "replayed").otherwise("mismatch").alias("verdict"))


@query(
    "token_bucket",
    """WITH r AS (SELECT user_id, list({'s': epoch_us(ts) / 1e6, 'n': CAST(1 + event_id % 3 AS DOUBLE)} ORDER BY ts, 1 + event_id % 3) AS rs FROM events GROUP BY 1),
    a AS (SELECT user_id, list_reduce(list_transform(rs, lambda x: {'s': x.s, 'n': x.n, 'tokens': CAST(0 AS DOUBLE), 'granted': CAST(0 AS BIGINT), 'refused': CAST(0 AS BIGINT)}),
        lambda a, r: {'s': r.s, 'n': r.n, 'tokens': CASE WHEN least(3.0, a.tokens + (r.s - a.s) * (0.003 / 60)) >= r.n THEN least(3.0, a.tokens + (r.s - a.s) * (0.003 / 60)) - r.n ELSE least(3.0, a.tokens + (r.s - a.s) * (0.003 / 60)) END,
          'granted': a.granted + CASE WHEN least(3.0, a.tokens + (r.s - a.s) * (0.003 / 60)) >= r.n THEN 1 ELSE 0 END,
          'refused': a.refused + CASE WHEN least(3.0, a.tokens + (r.s - a.s) * (0.003 / 60)) >= r.n THEN 0 ELSE 1 END},
        {'s': rs[1].s, 'n': 0.0, 'tokens': 3.0, 'granted': 0, 'refused': 0}) AS f FROM r)
    SELECT user_id, CAST(f.granted AS BIGINT) AS granted, CAST(f.refused AS BIGINT) AS refused, round(f.tokens, 4) AS tokens FROM a""",
)
def token_bucket(spark: SparkSession, d: str) -> DataFrame:
    """A quota fold per Source over its time-ordered requests: capacity 3, a token every 20,000 s."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    r = load(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.struct(at.alias("at"), (1 + F.col("event_id") % 3).cast("double").alias("n"))).alias("rs"))
    f = r.select("user_id", rules.token_bucket(F.col("rs"), 3.0, 0.003).alias("f"))
    return f.select("user_id", "f.granted", "f.refused", F.round("f.tokens", 4).alias("tokens"))


@query("quota_wait", "SELECT event_id, greatest(1, CAST(ceil((1 + event_id % 60 - value) / (50.0 / 60)) AS BIGINT)) AS wait_s FROM events")
def quota_wait(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select("event_id", rules.wait_seconds(1 + F.col("event_id") % 60, F.col("value")).alias("wait_s"))


@query("semi_active", f"WITH {REQUESTS_SQL} SELECT c_custkey AS document_id FROM customer WHERE EXISTS (SELECT 1 FROM requests r WHERE r.document_id = c_custkey AND state <> 'ended')")
def semi_active(spark: SparkSession, d: str) -> DataFrame:
    """Documents with an active request, which is reused instead of another being made."""
    docs = load(spark, d, "customer").select(F.col("c_custkey").alias("document_id"))
    return docs.join(requests(spark, d).where("state <> 'ended'"), "document_id", "left_semi")


@query("anti_create", f"WITH {REQUESTS_SQL} SELECT c_custkey AS document_id, 'req_' || substr(sha256('req|' || c_custkey), 1, 16) AS request_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.document_id = c_custkey AND state <> 'ended')")
def anti_create(spark: SparkSession, d: str) -> DataFrame:
    """Requests to be created where none is active, with ids that a rerun repeats."""
    docs = load(spark, d, "customer").select(F.col("c_custkey").alias("document_id"))
    new = docs.join(requests(spark, d).where("state <> 'ended'"), "document_id", "left_anti")
    return new.select("document_id", F.concat(F.lit("req_"), F.substring(F.sha2(F.concat(F.lit("req|"), F.col("document_id").cast("string")), 256), 1, 16)).alias("request_id"))


@query("one_active_audit", f"WITH {REQUESTS_SQL} SELECT document_id, count(*) AS active FROM requests WHERE state <> 'ended' GROUP BY 1 HAVING count(*) > 1")
def one_active_audit(spark: SparkSession, d: str) -> DataFrame:
    """The invariant of at most one active request a document, as a query of its violations."""
    return requests(spark, d).where("state <> 'ended'").groupBy("document_id").agg(F.count("*").alias("active")).where("active > 1")


@query("carry_over", f"WITH {ITEMS_SQL} SELECT n.batch_id, n.idx, o.batch_id AS from_batch FROM items n LEFT JOIN (SELECT path, size, max(batch_id) AS batch_id FROM items WHERE batch_id % 2 = 0 GROUP BY 1, 2) o ON o.path = n.path AND o.size = n.size WHERE n.batch_id % 2 = 1")
def carry_over(spark: SparkSession, d: str) -> DataFrame:
    """Files that an earlier revision holds by path and digest keep their place; the others (null) are uploads."""
    i = items(spark, d)
    old = i.where("batch_id % 2 = 0").groupBy("path", "size").agg(F.max("batch_id").alias("from_batch"))
    return i.where("batch_id % 2 = 1").join(old, ["path", "size"], "left").select("batch_id", "idx", "from_batch")


@query("unreferenced_objects", "SELECT DISTINCT p_partkey AS object FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def unreferenced_objects(spark: SparkSession, d: str) -> DataFrame:
    """Stored objects that no revision refers to."""
    used = load(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("object"))
    return load(spark, d, "part").select(F.col("p_partkey").alias("object")).distinct().join(used, "object", "left_anti")


@query("upload_target", f"WITH {ITEMS_SQL} SELECT r.o_orderkey AS batch_id, w.idx, i.path, 'documents/' || i.document_id || '/files/' || r.o_orderkey || '/' || w.idx || '/' || sha256(i.path) AS custody_key FROM orders r CROSS JOIN (SELECT CAST(3 AS BIGINT) AS idx) w LEFT JOIN items i ON i.batch_id = r.o_orderkey AND i.idx = w.idx")
def upload_target(spark: SparkSession, d: str) -> DataFrame:
    """The item at an index of each batch, if there, and the key that its file is kept under."""
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("batch_id"), F.lit(3).cast("long").alias("idx"))
    key = custody_key(F.col("document_id").cast("string"), F.col("batch_id").cast("string"), F.col("idx").cast("string"), F.sha2("path", 256))
    return o.join(items(spark, d).select("batch_id", "idx", "path", "document_id"), ["batch_id", "idx"], "left").select("batch_id", "idx", "path", F.when(F.col("path").isNotNull(), key).alias("custody_key"))


@query("resource_non_empty", "SELECT s_suppkey AS resource_id, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49.5) AS non_empty FROM supplier")
def resource_non_empty(spark: SparkSession, d: str) -> DataFrame:
    held = load(spark, d, "lineitem").where("l_quantity > 49.5").select(F.col("l_suppkey").alias("resource_id")).distinct().withColumn("held", F.lit(True))
    return load(spark, d, "supplier").select(F.col("s_suppkey").alias("resource_id")).join(held, "resource_id", "left").select("resource_id", F.coalesce("held", F.lit(False)).alias("non_empty"))


@query("adoption_current", "SELECT p_brand AS media_type, max(p_partkey) AS sequence, CASE WHEN arg_max(p_size, p_partkey) > 25 THEN NULL ELSE arg_max(p_type, p_partkey) END AS adopted, max(p_partkey) + 1 AS next_sequence FROM part GROUP BY 1")
def adoption_current(spark: SparkSession, d: str) -> DataFrame:
    """Each media type's highest adoption; a cancelled one leaves none, and earlier ones do not come back."""
    p = load(spark, d, "part").groupBy(F.col("p_brand").alias("media_type")).agg(F.max("p_partkey").alias("sequence"), F.max_by(F.struct("p_size", "p_type"), "p_partkey").alias("last"))
    return p.select("media_type", "sequence", F.when(F.col("last.p_size") <= 25, F.col("last.p_type")).alias("adopted"), (F.col("sequence") + 1).alias("next_sequence"))


@query("outcome_mapping", "SELECT event_id, CASE WHEN event_type <> 'error' THEN 'pending' WHEN user_id % 2 = 0 THEN 'rejected' ELSE 'failed' END AS outcome, CASE WHEN user_id % 2 = 0 THEN props ELSE 'The platform could not process this document.' END AS message FROM events")
def outcome_mapping(spark: SparkSession, d: str) -> DataFrame:
    cause = F.when(F.col("user_id") % 2 == 0, "source").otherwise("platform")
    return load(spark, d, "events").select("event_id", rules.outcome(F.col("event_type") != "error", cause).alias("outcome"), rules.error_message(cause, F.col("props")).alias("message"))


@query("first_terminal", f"WITH {FEED_SQL} SELECT document_uid AS request_id, arg_min(kind, position) AS ended_by, min(position) AS at, count(*) - 1 AS ignored FROM feed WHERE kind IN ('purchase', 'error') GROUP BY 1")
def first_terminal(spark: SparkSession, d: str) -> DataFrame:
    """The first terminal event ends a request; later ones change nothing."""
    return feed(spark, d).where(F.col("kind").isin("purchase", "error")).groupBy(F.col("document_uid").alias("request_id")).agg(F.min_by("kind", "position").alias("ended_by"), F.min("position").alias("at"), (F.count("*") - 1).alias("ignored"))


@query(
    "report_intake",
    f"""WITH {FEED_SQL}, x AS (SELECT event_id, document_uid, kind, CAST(round(value) AS BIGINT) AS seq FROM feed),
    y AS (SELECT *, max(CASE WHEN kind <> 'error' THEN seq END) OVER (PARTITION BY document_uid ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM x)
    SELECT event_id, CASE WHEN kind = 'error' THEN 'bad_stage' WHEN seq = top THEN 'repeated' WHEN seq < top THEN 'out_of_order' ELSE 'recorded' END AS verdict FROM y""",
)
def report_intake(spark: SparkSession, d: str) -> DataFrame:
    """Status reports against the highest sequence recorded before, per attempt."""
    before = Window.partitionBy("document_uid").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    x = feed(spark, d).select("event_id", "document_uid", "kind", F.round("value").cast("long").alias("seq"))
    x = x.withColumn("top", F.max(F.when(F.col("kind") != "error", F.col("seq"))).over(before))
    verdict = F.when(F.col("kind") == "error", "bad_stage").when(F.col("seq") == F.col("top"), "repeated").when(F.col("seq") < F.col("top"), "out_of_order").otherwise("recorded")
    return x.select("event_id", verdict.alias("verdict"))


@query("report_strictness", "SELECT event_id, event_type = 'error' AS failed, CASE WHEN event_type = 'error' AND json_extract(props, '$.k') IS NULL THEN 'error_missing' WHEN event_type <> 'error' AND CAST(json_extract(props, '$.k') AS BIGINT) > 90 THEN 'error_present' END AS violation FROM events")
def report_strictness(spark: SparkSession, d: str) -> DataFrame:
    """A failed report must carry an error, and no other may."""
    k = F.get_json_object("props", "$.k").cast("long")
    failed = F.col("event_type") == "error"
    return load(spark, d, "events").select("event_id", failed.alias("failed"), F.when(failed & k.isNull(), "error_missing").when(~failed & (k > 90), "error_present").alias("violation"))


@query("report_details", "SELECT event_id, event_type AS stage, CAST(json_extract(props, '$.k') AS BIGINT) AS done, round(value, 3) AS progress FROM events")
def report_details(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return load(spark, d, "events").select("event_id", F.col("event_type").alias("stage"), parsed["k"].alias("done"), F.round("value", 3).alias("progress"))


@query("redispatch_missing", f"WITH {REQUESTS_SQL}, {NOW_SQL} SELECT request_id, state = 'processing' AND today - created_day > 200 AS redispatched, CASE WHEN state = 'processing' AND today - created_day > 200 THEN today ELSE created_day END AS available_at FROM requests, now WHERE state <> 'ended'")
def redispatch_missing(spark: SparkSession, d: str) -> DataFrame:
    """Requests that were dispatched but run nowhere are due again now."""
    r = requests(spark, d)
    gone = (F.col("state") == "processing") & (F.col("today") - F.col("created_day") > 200)
    return r.where("state <> 'ended'").join(today(r)).select("request_id", gone.alias("redispatched"), F.when(gone, F.col("today")).otherwise(F.col("created_day")).alias("available_at"))


@query("reconciler_counts", f"WITH {REQUESTS_SQL}, {NOW_SQL} SELECT CASE WHEN state = 'processing' AND today - created_day > 200 THEN 'redispatched' WHEN state = 'processing' THEN 'running' ELSE 'recorded' END AS action, count(*) AS n FROM requests, now GROUP BY 1")
def reconciler_counts(spark: SparkSession, d: str) -> DataFrame:
    r = requests(spark, d)
    run = F.col("state") == "processing"
    action = F.when(run & (F.col("today") - F.col("created_day") > 200), "redispatched").when(run, "running").otherwise("recorded")
    return r.join(today(r)).groupBy(action.alias("action")).agg(F.count("*").alias("n"))


@query("batch_expiry", f"WITH {ITEMS_SQL}, b AS (SELECT batch_id, max(day) AS expires FROM items GROUP BY 1) SELECT b.batch_id, expires < 9500 AS expired, count(*) FILTER (status = 'declared' AND expires < 9500) AS expired_items FROM b JOIN items USING (batch_id) GROUP BY 1, 2")
def batch_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Open batches past their time expire, and so do their declared items: one aggregation, no join back."""
    out = items(spark, d).groupBy("batch_id").agg(F.max("day").alias("expires"), F.count_if(F.col("status") == "declared").alias("declared"))
    expired = F.col("expires") < 9500
    return out.select("batch_id", expired.alias("expired"), F.when(expired, F.col("declared")).otherwise(F.lit(0).cast("long")).alias("expired_items"))


@query("upload_cleanup", f"WITH {ITEMS_SQL}, b AS (SELECT batch_id, max(day) AS ended FROM items GROUP BY 1) SELECT batch_id, ended + 1 AS eligible_at FROM b WHERE ended + 1 <= 10500 AND batch_id % 5 <> 0")
def upload_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Ended batches whose grace is over and that are not cleaned yet."""
    b = items(spark, d).where("batch_id % 5 <> 0").groupBy("batch_id").agg((F.max("day") + 1).alias("eligible_at"))
    return b.where("eligible_at <= 10500").select("batch_id", "eligible_at")


@query("resource_resolution", "SELECT o_orderkey AS request_id, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN 'explicit' END, CASE WHEN c_acctbal > 0 THEN 'document' END, CASE WHEN c_nationkey < 20 THEN 'default' END) AS resource FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def resource_resolution(spark: SparkSession, d: str) -> DataFrame:
    """An explicit Resource, else the document's, else the default, else none."""
    o = load(spark, d, "orders").join(load(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select(F.col("o_orderkey").alias("request_id"), F.coalesce(F.when(F.col("o_orderkey") % 4 == 0, "explicit"), F.when(F.col("c_acctbal") > 0, "document"), F.when(F.col("c_nationkey") < 20, "default")).alias("resource"))


@query("resource_ids", "SELECT p_partkey, replace(replace(p_type, '%', '%25'), ' ', '%20') || ':' || p_name AS resource_id FROM part")
def resource_ids(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", F.concat_ws(":", percent_encoded(F.col("p_type")), "p_name").alias("resource_id"))


RELATION_SQL = f"WITH {FEED_SQL}, last AS (SELECT source_id AS resource, document_uid AS subject, arg_max(kind, position) AS op FROM feed WHERE kind IN ('view', 'click', 'signup') GROUP BY 1, 2)"


def relations(spark: SparkSession, d: str) -> DataFrame:
    """Grants and revocations folded to the last of each pair: view grants reader, signup maintainer, click revokes."""
    return feed(spark, d).where(F.col("kind").isin("view", "click", "signup")).groupBy(F.col("source_id").alias("resource"), F.col("document_uid").alias("subject")).agg(F.max_by("kind", "position").alias("op"))


@query("relation_permissions", RELATION_SQL + " SELECT resource, subject, op = 'signup' AS manage, op = 'signup' AS place, op = 'view' AS read FROM last WHERE op <> 'click'")
def relation_permissions(spark: SparkSession, d: str) -> DataFrame:
    op = F.col("op")
    return relations(spark, d).where(op != "click").select("resource", "subject", (op == "signup").alias("manage"), (op == "signup").alias("place"), (op == "view").alias("read"))


@query("authorization_decisions", RELATION_SQL + ", asked AS (SELECT DISTINCT user_id % 25 AS resource, 'doc_' || user_id AS subject FROM events) SELECT a.resource, a.subject, CASE WHEN a.resource >= 20 THEN 'no_resource' WHEN l.op = 'signup' THEN 'allow' ELSE 'no_relation' END AS decision FROM asked a LEFT JOIN last l USING (resource, subject)")
def authorization_decisions(spark: SparkSession, d: str) -> DataFrame:
    asked = load(spark, d, "events").select((F.col("user_id") % 25).alias("resource"), F.concat(F.lit("doc_"), F.col("user_id").cast("string")).alias("subject")).distinct()
    decision = F.when(F.col("resource") >= 20, "no_resource").when(F.col("op") == "signup", "allow").otherwise("no_relation")
    return asked.join(relations(spark, d), ["resource", "subject"], "left").select("resource", "subject", decision.alias("decision"))


@query("resource_change_log", f"WITH {FEED_SQL}, x AS (SELECT position, source_id, kind, lag(kind) OVER (PARTITION BY source_id, document_uid ORDER BY position) AS prev FROM feed) SELECT source_id, count(*) AS writes, count(*) FILTER (prev IS DISTINCT FROM kind) AS effective FROM x GROUP BY 1")
def resource_change_log(spark: SparkSession, d: str) -> DataFrame:
    """Writes and those that changed anything: only these are logged."""
    x = feed(spark, d).withColumn("prev", F.lag("kind").over(Window.partitionBy("source_id", "document_uid").orderBy("position")))
    return x.groupBy("source_id").agg(F.count("*").alias("writes"), F.count_if(~F.col("prev").eqNullSafe(F.col("kind"))).alias("effective"))


@query("current_generation", "SELECT o_custkey AS document_id, arg_max(o_orderkey, struct_pack(live := o_orderstatus <> 'F', day := o_orderdate, k := o_orderkey)) AS generation, bool_or(o_orderstatus <> 'F') AS live FROM orders GROUP BY 1")
def current_generation(spark: SparkSession, d: str) -> DataFrame:
    """The live generation of a document, else the last deleted one."""
    live = F.col("o_orderstatus") != "F"
    return load(spark, d, "orders").groupBy(F.col("o_custkey").alias("document_id")).agg(F.max_by("o_orderkey", F.struct(live, F.col("o_orderdate"), F.col("o_orderkey"))).alias("generation"), F.bool_or(live).alias("live"))


@query("readiness", f"WITH {FEED_SQL}, s AS (SELECT document_uid, list_sort(list_distinct(list(kind))) AS serving, max(value) AS v FROM feed WHERE kind <> 'error' GROUP BY 1) SELECT document_uid, CASE WHEN document_uid LIKE '%9' THEN 'deleted' WHEN NOT list_has_all(serving, ['click', 'purchase', 'signup', 'view']) THEN 'not_ready' WHEN v < 97 THEN 'ready_stale' ELSE 'ready' END AS readiness FROM s")
def readiness(spark: SparkSession, d: str) -> DataFrame:
    s = feed(spark, d).where("kind <> 'error'").groupBy("document_uid").agg(F.collect_set("kind").alias("serving"), F.max("value").alias("v"))
    need = F.array(*[F.lit(k) for k in ("click", "purchase", "signup", "view")])
    return s.select("document_uid", rules.readiness(F.col("document_uid").endswith("9"), need, F.col("serving"), F.col("v") < 97).alias("readiness"))


@query("promotion_decisions", "WITH w AS (SELECT p_brand AS build, list_sort(list_distinct(list(p_type))) AS wanted FROM part GROUP BY 1), g AS (SELECT p_brand AS build, list_distinct(list(p_type)) AS polled FROM part WHERE p_size > 10 GROUP BY 1) SELECT w.build, CASE WHEN len(list_filter(wanted, lambda x: NOT list_contains(coalesce(polled, []), x))) = 0 THEN 'promote' ELSE 'wait' END AS decision, len(list_filter(wanted, lambda x: NOT list_contains(coalesce(polled, []), x))) AS missing FROM w LEFT JOIN g USING (build)")
def promotion_decisions(spark: SparkSession, d: str) -> DataFrame:
    """A listed build becomes current once all its queues are polled."""
    p = load(spark, d, "part").groupBy(F.col("p_brand").alias("build")).agg(F.collect_set("p_type").alias("wanted"), F.collect_set(F.when(F.col("p_size") > 10, F.col("p_type"))).alias("polled"))
    missing = F.size(F.array_except("wanted", "polled")).cast("long")
    return p.select("build", F.when(missing == 0, "promote").otherwise("wait").alias("decision"), missing.alias("missing"))


@query("builds_off_list", "SELECT DISTINCT p_brand AS build FROM part WHERE p_brand IS NOT NULL EXCEPT SELECT p_brand FROM part WHERE p_size = 1 AND p_partkey % 7 = 0")
def builds_off_list(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    return p.select(F.col("p_brand").alias("build")).distinct().exceptAll(p.where("p_size = 1 and p_partkey % 7 = 0").select("p_brand").distinct())


@query("registration_checks", "SELECT c_mktsegment AS credential, count(DISTINCT c_nationkey) AS tenants, count(DISTINCT c_nationkey) > 1 AS violation FROM customer GROUP BY 1")
def registration_checks(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("credential")).agg(F.count_distinct("c_nationkey").alias("tenants"))
    return c.withColumn("violation", F.col("tenants") > 1)


@query("scope_filter", "SELECT user_id, epoch_us(ts) // 86400000000 AS day, list_has_any(list_distinct(list(event_type)), ['error', 'signup']) AS allowed FROM events GROUP BY 1, 2")
def scope_filter(spark: SparkSession, d: str) -> DataFrame:
    scopes = F.array(F.lit("error"), F.lit("signup"))
    return load(spark, d, "events").groupBy("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).alias("day")).agg(F.arrays_overlap(F.collect_set("event_type"), scopes).alias("allowed"))


@query("request_error_envelope", "SELECT event_id, CASE WHEN event_type = 'error' THEN 503 WHEN value < 5 THEN 429 ELSE 200 END AS status, CASE WHEN event_type = 'error' THEN 1 WHEN value < 5 THEN CAST(ceil(value) AS INTEGER) END AS retry_after FROM events")
def request_error_envelope(spark: SparkSession, d: str) -> DataFrame:
    error = F.col("event_type") == "error"
    return load(spark, d, "events").select("event_id", F.when(error, 503).when(F.col("value") < 5, 429).otherwise(200).alias("status"), F.when(error, 1).when(F.col("value") < 5, F.ceil("value").cast("int")).alias("retry_after"))


@query("body_digest", "SELECT o_orderkey, sha256('{\"custkey\": ' || o_custkey || ', \"status\": \"' || o_orderstatus || '\"}') AS body_sha256 FROM orders")
def body_digest(spark: SparkSession, d: str) -> DataFrame:
    """sha256 of sorted-key JSON with the separators that the client's writer uses."""
    body = F.concat(F.lit('{"custkey": '), F.col("o_custkey").cast("string"), F.lit(', "status": "'), F.col("o_orderstatus"), F.lit('"}'))
    return load(spark, d, "orders").select("o_orderkey", F.sha2(body, 256).alias("body_sha256"))
