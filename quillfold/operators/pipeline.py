"""Content-addressed processing: keys, reuse, page groups, inventory, retry chains, outcomes, results, token accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions.scores import nearest_rank
from quillfold.registry import query
from quillfold.sources.tables import load


@query("reuse_key", "SELECT doc_id, sha256('[\"doc_' || doc_id || '\",\"parse@1\",[],\"' || sha256(source) || '\",[\"' || sha256(text) || '\"]]') AS reuse_key FROM documents")
def reuse_key(spark: SparkSession, d: str) -> DataFrame:
    """sha256 of canonical JSON of document, method, components, module digest and input digests (all ASCII)."""
    parts = [F.lit('["doc_'), F.col("doc_id").cast("string"), F.lit('","parse@1",[],"'), F.sha2("source", 256), F.lit('",["'), F.sha2("text", 256), F.lit('"]]')]
    return load(spark, d, "documents").select("doc_id", F.sha2(F.concat(*parts), 256).alias("reuse_key"))


@query("reuse_lookup", "WITH k AS (SELECT doc_id, sha256(text) AS key FROM documents), r AS (SELECT DISTINCT key FROM k WHERE doc_id % 4 = 0) SELECT k.doc_id, r.key IS NOT NULL AS reused FROM k LEFT JOIN r USING (key)")
def reuse_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Keys that are registered are not computed again."""
    k = load(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    registered = k.where("doc_id % 4 = 0").select("key").distinct().withColumn("r", F.lit(True))
    return k.join(registered, "key", "left").select("doc_id", F.coalesce("r", F.lit(False)).alias("reused"))


@query("write_once", "WITH k AS (SELECT doc_id, sha256(text) AS key FROM documents) SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1 AS created FROM k")
def write_once(spark: SparkSession, d: str) -> DataFrame:
    """The first writer of a key creates it; for the others it is there."""
    k = load(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return k.withColumn("created", F.row_number().over(Window.partitionBy("key").orderBy("doc_id")) == 1)


@query("page_groups", "WITH p AS (SELECT doc_id, greatest(1, CAST(ceil(n_chars / 300.0) AS INTEGER)) AS n FROM documents) SELECT doc_id, CAST(g AS INTEGER) AS first, CAST(least(g + 4, n) AS INTEGER) AS last FROM (SELECT doc_id, n, unnest(range(1, n + 1, 5)) AS g FROM p)")
def page_groups(spark: SparkSession, d: str) -> DataFrame:
    """Pages 1..n in groups of five."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 300).cast("int"))
    p = load(spark, d, "documents").select("doc_id", n.alias("n"))
    return p.select("doc_id", "n", F.explode(F.expr("sequence(1, n, 5)")).alias("first")).select("doc_id", "first", F.least(F.col("first") + 4, F.col("n")).alias("last"))


@query("group_coverage", "WITH x AS (SELECT l_orderkey AS doc, l_linenumber AS first, l_linenumber + CAST(l_quantity AS INTEGER) % 2 AS last, lag(l_linenumber + CAST(l_quantity AS INTEGER) % 2) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS prev FROM lineitem) SELECT doc, coalesce(bool_and(prev IS NULL OR prev + 1 = first), true) AND min(first) = 1 AS covered, max(last) AS pages FROM x GROUP BY 1")
def group_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Groups must be contiguous from page 1: each starts after the one before."""
    li = load(spark, d, "lineitem")
    x = li.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("first"), "l_quantity", (F.col("l_linenumber") + F.col("l_quantity").cast("int") % 2).alias("last"))
    x = x.withColumn("prev", F.lag("last").over(Window.partitionBy("doc").orderBy("first", "l_quantity")))
    return x.groupBy("doc").agg((F.bool_and(F.col("prev").isNull() | (F.col("prev") + 1 == F.col("first"))) & (F.min("first") == 1)).alias("covered"), F.max("last").alias("pages"))


@query("inventory_items", "WITH m AS (SELECT * FROM (VALUES ('code@1', 'en', 1), ('formula@1', 'fr', 2), ('picture@2', 'de', 3), ('table@1', 'en', 4)) t(method, label, ord)) SELECT method || ':' || (row_number() OVER (PARTITION BY method ORDER BY doc_id) - 1) AS item_id, method, doc_id AS target FROM documents JOIN m ON label = lang UNION ALL SELECT 'summary@1:#', 'summary@1', -1")
def inventory_items(spark: SparkSession, d: str) -> DataFrame:
    """One item per method and matching target in order, and one for the document as a whole.

    Numbers are per method; a hot method's rows are numbered by one task's window, as its order is one sequence.
    """
    methods = spark.createDataFrame([("code@1", "en"), ("formula@1", "fr"), ("picture@2", "de"), ("table@1", "en")], "method string, label string")
    hit = load(spark, d, "documents").join(F.broadcast(methods), F.col("lang") == F.col("label"))
    k = F.row_number().over(Window.partitionBy("method").orderBy("doc_id")) - 1
    found = hit.select(F.concat_ws(":", "method", k.cast("string")).alias("item_id"), "method", F.col("doc_id").alias("target"))
    whole = spark.createDataFrame([("summary@1:#", "summary@1", -1)], "item_id string, method string, target long")
    return found.union(whole)


CHAIN_SQL = """r AS (SELECT conv_id, turn, CASE WHEN length(text) % 5 = 0 THEN NULL WHEN length(text) % 5 = 1 THEN 'unavailable' WHEN length(text) % 5 = 2 THEN 'invalid' WHEN length(text) % 11 = 0 THEN 'refused' ELSE 'ok' END AS raw FROM conversations),
    c AS (SELECT conv_id, turn, coalesce(raw, 'unavailable') AS result FROM r),
    s AS (SELECT conv_id, min(turn) FILTER (result IN ('ok', 'refused')) AS ended, list(struct_pack(t := turn, r := result) ORDER BY turn) AS rs FROM c GROUP BY 1)"""


def receipts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts at an item (turns of a conversation), with a missing result counted as unavailable."""
    n = F.length("text")
    raw = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "unavailable").when(n % 5 == 2, "invalid").when(n % 11 == 0, "refused").otherwise("ok")
    return load(spark, d, "conversations").select("conv_id", "turn", F.coalesce(raw, F.lit("unavailable")).alias("result"), n.alias("chars"), "role")


@query("retry_chain", f"WITH {CHAIN_SQL}, i AS (SELECT conv_id, turn, result, sum(CASE WHEN result = 'invalid' THEN 1 ELSE 0 END) OVER w AS invalids, row_number() OVER w AS attempt FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), e AS (SELECT conv_id, min(attempt) FILTER (result IN ('ok', 'refused') OR invalids >= 2 OR attempt >= 4) AS stop FROM i GROUP BY 1) SELECT i.conv_id, CAST(coalesce(stop, max(attempt)) AS INTEGER) AS attempts, coalesce(any_value(CASE WHEN attempt = stop THEN CASE WHEN result = 'ok' THEN 'success' WHEN result = 'refused' THEN 'REFUSED' WHEN invalids >= 2 THEN 'INVALID_OUTPUT' ELSE 'SERVICE_UNAVAILABLE' END END), 'open') AS outcome FROM i JOIN e USING (conv_id) GROUP BY i.conv_id, stop")
def retry_chain(spark: SparkSession, d: str) -> DataFrame:
    """Receipts folded in order: ok and refused end a chain, so do two invalid answers or four attempts."""
    start = F.struct(F.lit(0).alias("attempts"), F.lit(0).alias("invalids"), F.lit(None).cast("string").alias("outcome"))

    def step(a, r):
        n, bad = a["attempts"] + 1, a["invalids"] + (r["result"] == "invalid").cast("int")
        end = F.when(r["result"] == "ok", "success").when(r["result"] == "refused", "REFUSED").when(bad >= 2, "INVALID_OUTPUT").when(n >= 4, "SERVICE_UNAVAILABLE")
        return F.when(a["outcome"].isNotNull(), a).otherwise(F.struct(n.alias("attempts"), bad.alias("invalids"), end.alias("outcome")))

    g = receipts(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "result"))).alias("rs"))
    f = g.select("conv_id", F.aggregate("rs", start, step).alias("f"))
    return f.select("conv_id", "f.attempts", F.coalesce("f.outcome", F.lit("open")).alias("outcome"))


@query("last_receipt", f"WITH {CHAIN_SQL} SELECT conv_id, arg_max(result, turn) AS last_result, max(turn) AS last_turn FROM c GROUP BY 1")
def last_receipt(spark: SparkSession, d: str) -> DataFrame:
    return receipts(spark, d).groupBy("conv_id").agg(F.max_by("result", "turn").alias("last_result"), F.max("turn").alias("last_turn"))


@query("request_cap", f"WITH {CHAIN_SQL} SELECT conv_id, count(*) AS requests, 2 * count(*) FILTER (result = 'ok') + 1 AS cap, count(*) > 2 * count(*) FILTER (result = 'ok') + 1 AS capped FROM c GROUP BY 1")
def request_cap(spark: SparkSession, d: str) -> DataFrame:
    n, ok = F.count("*"), F.count_if(F.col("result") == "ok")
    return receipts(spark, d).groupBy("conv_id").agg(n.alias("requests"), (2 * ok + 1).alias("cap"), (n > 2 * ok + 1).alias("capped"))


@query("transient_split", f"WITH {CHAIN_SQL} SELECT conv_id, turn, CASE WHEN result = 'unavailable' THEN 'transient' ELSE 'registered' END AS path FROM c")
def transient_split(spark: SparkSession, d: str) -> DataFrame:
    """Unavailable outcomes are never registered, so that a redrive can compute them."""
    return receipts(spark, d).select("conv_id", "turn", F.when(F.col("result") == "unavailable", "transient").otherwise("registered").alias("path"))


@query("receipt_summary", f"WITH {CHAIN_SQL}, x AS (SELECT c.*, length(text) AS chars FROM c JOIN conversations USING (conv_id, turn)) SELECT conv_id, count(*) AS requests, count(*) FILTER (result = 'ok') AS ok, count(*) FILTER (result = 'invalid') AS invalid, min(chars) AS least, list_sort(list(chars))[len(list(chars)) // 2 + 1] AS middle, max(chars) AS most FROM x GROUP BY 1")
def receipt_summary(spark: SparkSession, d: str) -> DataFrame:
    """Requests by result, and the least, upper-median and largest latency (here: length)."""
    r = receipts(spark, d).withColumn("chars", F.col("chars").cast("long"))
    return r.groupBy("conv_id").agg(F.count("*").alias("requests"), F.count_if(F.col("result") == "ok").alias("ok"), F.count_if(F.col("result") == "invalid").alias("invalid"), F.min("chars").alias("least"), nearest_rank(F.collect_list("chars"), 0.5, "upper").alias("middle"), F.max("chars").alias("most"))


STATUS_SQL = """o AS (SELECT d.doc_id, d.lang AS method, CASE WHEN d.n_chars < 100 THEN 'no_text' WHEN l.quality = 0 THEN 'failed' ELSE 'success' END AS outcome, l.toxic,
      CASE WHEN l.toxic = 1 THEN ['TOXIC'] ELSE [] END AS own, CASE WHEN d.doc_id % 7 = 0 THEN ['CHECK_LOW'] ELSE [] END AS checked FROM documents d LEFT JOIN labels l USING (doc_id)),
    s AS (SELECT *, list_concat(own, checked) AS contradictions FROM o),
    st AS (SELECT doc_id, method, contradictions, CASE WHEN outcome = 'failed' THEN 'failed' WHEN len(contradictions) > 0 THEN 'disputed' ELSE 'unverified' END AS status, CASE WHEN outcome = 'failed' THEN 'QUALITY' WHEN len(contradictions) > 0 THEN contradictions[1] WHEN outcome = 'no_text' THEN 'NO_TEXT' END AS reason FROM s)"""


def statuses(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes with their check's contradictions appended, and the status rule: failed, else disputed, else unverified."""
    o = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id", "left")
    none = F.array().cast("array<string>")
    outcome = F.when(F.col("n_chars") < 100, "no_text").when(F.col("quality") == 0, "failed").otherwise("success")
    both = F.concat(F.when(F.col("toxic") == 1, F.array(F.lit("TOXIC"))).otherwise(none), F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("CHECK_LOW"))).otherwise(none))
    s = o.select("doc_id", F.col("lang").alias("method"), outcome.alias("outcome"), both.alias("contradictions"))
    disputed = F.size("contradictions") > 0
    status = F.when(F.col("outcome") == "failed", "failed").when(disputed, "disputed").otherwise("unverified")
    reason = F.when(F.col("outcome") == "failed", "QUALITY").when(disputed, F.get("contradictions", F.lit(0))).when(F.col("outcome") == "no_text", "NO_TEXT")
    return s.select("doc_id", "method", "outcome", "contradictions", status.alias("status"), reason.alias("reason"))


@query("status_rule", f"WITH {STATUS_SQL} SELECT doc_id, method, status, reason, array_to_string(contradictions, ',') AS contradictions FROM st")
def status_rule(spark: SparkSession, d: str) -> DataFrame:
    return statuses(spark, d).select("doc_id", "method", "status", "reason", F.array_join("contradictions", ",").alias("contradictions"))


@query("status_counts", f"WITH {STATUS_SQL} SELECT method, count(*) FILTER (status = 'unverified' AND reason IS NULL) AS unverified, count(*) FILTER (status = 'disputed') AS disputed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (reason = 'NO_TEXT') AS no_text FROM st GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Disjoint buckets a method."""
    bucket = F.when(F.col("reason").eqNullSafe("NO_TEXT"), "no_text").otherwise(F.col("status"))
    s = statuses(spark, d).select("method", bucket.alias("bucket"))
    return s.groupBy("method").pivot("bucket", ["unverified", "disputed", "failed", "no_text"]).count().na.fill(0)


@query("status_tally", f"WITH {STATUS_SQL} SELECT concat_ws(' ', method, status, reason) AS key, count(*) AS n FROM st GROUP BY 1")
def status_tally(spark: SparkSession, d: str) -> DataFrame:
    return statuses(spark, d).groupBy(F.concat_ws(" ", "method", "status", "reason").alias("key")).agg(F.count("*").alias("n"))


@query("missing_outcomes", "SELECT d.doc_id AS item_id, l.doc_id IS NULL AS integrity_failure FROM documents d LEFT JOIN labels l USING (doc_id)")
def missing_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """An inventory item without an outcome is an integrity failure."""
    have = load(spark, d, "labels").select("doc_id", F.lit(True).alias("have"))
    return load(spark, d, "documents").join(have, "doc_id", "left").select(F.col("doc_id").alias("item_id"), F.col("have").isNull().alias("integrity_failure"))


@query("judged_items", f"WITH {STATUS_SQL}, k AS (SELECT * FROM (VALUES ('en', 'coverage', 'text'), ('en', 'coverage', 'page'), ('fr', 'meaning', 'text')) t(method, chk, kind)) SELECT chk || ':' || doc_id AS check_id, s.doc_id, k.kind FROM s JOIN k USING (method) WHERE outcome = 'success'")
def judged_items(spark: SparkSession, d: str) -> DataFrame:
    """What is judged: successes of judged methods, with each input kind of the check."""
    checks = spark.createDataFrame([("en", "coverage", ["text", "page"]), ("fr", "meaning", ["text"])], "method string, chk string, kinds array<string>")
    s = statuses(spark, d).where("outcome = 'success'").join(F.broadcast(checks), "method")
    return s.select(F.concat_ws(":", "chk", F.col("doc_id").cast("string")).alias("check_id"), "doc_id", F.explode("kinds").alias("kind"))


@query("judgement_coverage", f"WITH {STATUS_SQL} SELECT s.method, count(*) AS items, count(*) FILTER (s.outcome = 'success') AS success, count(*) FILTER (s.outcome = 'success' AND s.toxic IS NOT NULL) AS scored, count(*) FILTER (s.outcome = 'success' AND s.toxic IS NULL) AS unjudged, count(*) FILTER (len(s.contradictions) > 0) AS flagged FROM s GROUP BY 1")
def judgement_coverage(spark: SparkSession, d: str) -> DataFrame:
    s = statuses(spark, d).join(load(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    ok = F.col("outcome") == "success"
    return s.groupBy("method").agg(F.count("*").alias("items"), F.count_if(ok).alias("success"), F.count_if(ok & F.col("toxic").isNotNull()).alias("scored"), F.count_if(ok & F.col("toxic").isNull()).alias("unjudged"), F.count_if(F.size("contradictions") > 0).alias("flagged"))


@query("field_fanout", "SELECT p_partkey AS item, unnest(['brand', 'type', 'size']) AS field, unnest([p_brand, p_type, CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END]) AS content FROM part")
def field_fanout(spark: SparkSession, d: str) -> DataFrame:
    """A record with fields gives one enrichment a field."""
    fields = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("content")) for n, c in (("brand", F.col("p_brand")), ("type", F.col("p_type")), ("size", F.when(F.col("p_size") > 25, F.col("p_size").cast("string"))))])
    return load(spark, d, "part").select(F.col("p_partkey").alias("item"), F.explode(fields).alias("f")).select("item", "f.field", "f.content")


@query("redrive_needed", f"WITH {CHAIN_SQL} SELECT conv_id, bool_or(result = 'unavailable') AS redrive FROM c GROUP BY 1")
def redrive_needed(spark: SparkSession, d: str) -> DataFrame:
    return receipts(spark, d).groupBy("conv_id").agg(F.bool_or(F.col("result") == "unavailable").alias("redrive"))


@query("limitations", "SELECT conv_id, coalesce('NO_TEXT_LAYER_PAGES: ' || string_agg(CAST(turn AS VARCHAR), ', ' ORDER BY turn) FILTER (length(text) < 120), 'none') AS limitation FROM conversations GROUP BY 1")
def limitations(spark: SparkSession, d: str) -> DataFrame:
    """A document's pages without text, named in order."""
    short = F.array_sort(F.collect_list(F.when(F.length("text") < 120, F.col("turn"))))
    g = load(spark, d, "conversations").groupBy("conv_id").agg(short.alias("n"))
    return g.select("conv_id", F.when(F.size("n") > 0, F.concat(F.lit("NO_TEXT_LAYER_PAGES: "), F.array_join(F.transform("n", lambda x: x.cast("string")), ", "))).otherwise("none").alias("limitation"))


@query("result_assembly", "SELECT conv_id, count(*) AS items, sha256(string_agg(turn || ':' || role || ':' || length(text), ';' ORDER BY turn)) AS result_sha256 FROM conversations GROUP BY 1")
def result_assembly(spark: SparkSession, d: str) -> DataFrame:
    """One result a request, its enrichments in order, with a digest."""
    row = F.concat_ws(":", F.col("turn").cast("string"), "role", F.length("text").cast("string"))
    g = load(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("items"), F.array_sort(F.collect_list(F.struct("turn", row.alias("r")))).alias("x"))
    return g.select("conv_id", "items", F.sha2(F.array_join(F.transform("x", lambda v: v["r"]), ";"), 256).alias("result_sha256"))


@query("activity_options", "SELECT c_custkey AS run, CAST(ceil(c_nationkey / 5.0) AS BIGINT) * 60 * 4 + 120 AS timeout_s, CASE WHEN c_mktsegment = 'BUILDING' THEN 4 ELSE 2 END AS priority FROM customer")
def activity_options(spark: SparkSession, d: str) -> DataFrame:
    """Time for a stage: rounds of five items, a deadline each, four attempts, and slack; and its priority."""
    rounds = F.ceil(F.col("c_nationkey") / 5).cast("long")
    return load(spark, d, "customer").select(F.col("c_custkey").alias("run"), (rounds * 60 * 4 + 120).alias("timeout_s"), F.when(F.col("c_mktsegment") == "BUILDING", 4).otherwise(2).alias("priority"))


@query("summary_complete", "SELECT conv_id, count(*) FILTER (length(text) > 80) AS done, count(*) AS chunks, count(*) FILTER (length(text) > 80) = count(*) AS complete FROM conversations GROUP BY 1")
def summary_complete(spark: SparkSession, d: str) -> DataFrame:
    done = F.count_if(F.length("text") > 80)
    return load(spark, d, "conversations").groupBy("conv_id").agg(done.alias("done"), F.count("*").alias("chunks"), (done == F.count("*")).alias("complete"))


@query("component_manifest", "SELECT s_suppkey AS component, CASE WHEN l.n IS NULL THEN 'missing' WHEN l.n % 2 = 1 THEN 'mismatch' ELSE 'ok' END AS verdict FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 48 GROUP BY 1) l ON l.l_suppkey = s_suppkey")
def component_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Listed files that are missing or differ."""
    have = load(spark, d, "lineitem").where("l_quantity > 48").groupBy(F.col("l_suppkey").alias("component")).agg(F.count("*").alias("n"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("component")).join(have, "component", "left")
    return s.select("component", F.when(F.col("n").isNull(), "missing").when(F.col("n") % 2 == 1, "mismatch").otherwise("ok").alias("verdict"))


@query("capacity_model", "WITH r AS (SELECT n_nationkey, n_nationkey * CAST(0.5 AS DOUBLE) AS rate FROM nation) SELECT n_nationkey AS scenario, rate, round(rate * 180892, 1) AS tpm, CAST(ceil(rate * CAST(20.6 AS DOUBLE) * 3 / 60) AS BIGINT) AS concurrency, CAST(ceil(rate * 62 / 60) AS BIGINT) AS workers FROM r")
def capacity_model(spark: SparkSession, d: str) -> DataFrame:
    """Tokens a minute, requests in flight and parse workers for documents a minute."""
    rate = F.col("n_nationkey") * 0.5
    return load(spark, d, "nation").select(F.col("n_nationkey").alias("scenario"), rate.alias("rate"), F.round(rate * 180892, 1).alias("tpm"), F.ceil(rate * 20.6 * 3 / 60).cast("long").alias("concurrency"), F.ceil(rate * 62 / 60).cast("long").alias("workers"))


TOKENS_SQL = """u AS (SELECT conv_id, role, CAST(length(text) AS BIGINT) AS prompt, CASE WHEN turn % 4 = 0 THEN NULL ELSE CAST(length(text) // 3 AS BIGINT) END AS completion, CASE WHEN turn % 2 = 0 THEN 'm-large' ELSE 'm-small' END AS model FROM conversations)"""


def usage(spark: SparkSession, d: str) -> DataFrame:
    """Token use of each request: prompt and completion, where measured, by model."""
    n = F.length("text").cast("long")
    return load(spark, d, "conversations").select("conv_id", "role", n.alias("prompt"), F.when(F.col("turn") % 4 != 0, F.floor(n / 3)).alias("completion"), F.when(F.col("turn") % 2 == 0, "m-large").otherwise("m-small").alias("model"))


@query("tokens_report", f"WITH {TOKENS_SQL}, dims AS (SELECT * FROM (SELECT DISTINCT conv_id FROM u), (SELECT DISTINCT role FROM u)) SELECT conv_id, role, count(prompt) AS requests, CAST(coalesce(sum(prompt), 0) AS BIGINT) AS tokens_in, CAST(coalesce(sum(completion), 0) AS BIGINT) AS tokens_out, count(prompt) - count(completion) AS unmeasured, coalesce(array_to_string(list_sort(list_distinct(list(model))), ','), '') AS models FROM dims LEFT JOIN u USING (conv_id, role) GROUP BY 1, 2")
def tokens_report(spark: SparkSession, d: str) -> DataFrame:
    """A row for each document and component, zero rows kept."""
    u = usage(spark, d)
    # components are a short list
    dims = u.select("conv_id").distinct().join(F.broadcast(u.select("role").distinct()))
    sums = u.groupBy("conv_id", "role").agg(F.count("*").alias("requests"), F.sum("prompt").alias("i"), F.sum("completion").alias("o"), F.count_if(F.col("completion").isNull()).alias("un"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"))
    zero = F.lit(0).cast("long")
    return dims.join(sums, ["conv_id", "role"], "left").select("conv_id", "role", F.coalesce("requests", zero).alias("requests"), F.coalesce("i", zero).alias("tokens_in"), F.coalesce("o", zero).alias("tokens_out"), F.coalesce("un", zero).alias("unmeasured"), F.coalesce("models", F.lit("")).alias("models"))


@query("tokens_distribution", f"WITH {TOKENS_SQL}, d AS (SELECT conv_id, sum(prompt + coalesce(completion, 0)) AS t, count(*) AS n FROM u GROUP BY 1) SELECT median(t) AS median_tokens, CAST(max(t) AS BIGINT) AS max_tokens, round(median(t / n), 6) AS median_a_request FROM d")
def tokens_distribution(spark: SparkSession, d: str) -> DataFrame:
    x = usage(spark, d).groupBy("conv_id").agg(F.sum(F.col("prompt") + F.coalesce("completion", F.lit(0))).alias("t"), F.count("*").alias("n"))
    return x.agg(F.median("t").alias("median_tokens"), F.max("t").alias("max_tokens"), F.round(F.median(F.col("t") / F.col("n")), 6).alias("median_a_request"))


@query("token_shares", f"WITH {TOKENS_SQL} SELECT role, round(sum(prompt) / sum(sum(prompt)) OVER (), 3) AS share, round(sum(prompt) / count(*), 4) AS a_request FROM u GROUP BY 1")
def token_shares(spark: SparkSession, d: str) -> DataFrame:
    g = usage(spark, d).groupBy("role").agg(F.sum("prompt").alias("p"), F.count("*").alias("n"))
    total = F.sum("p").over(Window.partitionBy())  # one row a component
    return g.select("role", F.round(F.try_divide(F.col("p"), total), 3).alias("share"), F.round(F.try_divide(F.col("p"), F.col("n")), 4).alias("a_request"))


@query("tokens_a_minute", f"WITH {TOKENS_SQL}, m AS (SELECT role, sum(prompt) / count(DISTINCT conv_id) AS mean FROM u GROUP BY 1), r AS (SELECT unnest([0.5, 6.94, 20.82, 50.0]) AS rate) SELECT coalesce(role, 'all') AS service, CAST(rate AS DOUBLE) AS rate, round(sum(mean) * CAST(rate AS DOUBLE), 2) AS tpm FROM m, r GROUP BY GROUPING SETS ((role, rate), (rate))")
def tokens_a_minute(spark: SparkSession, d: str) -> DataFrame:
    """Tokens a minute by rate, a service and all services together."""
    m = usage(spark, d).groupBy("role").agg((F.sum("prompt") / F.count_distinct("conv_id")).alias("mean"))
    member = m.select(F.explode(F.array("role", F.lit("all"))).alias("service"), "mean").groupBy("service").agg(F.sum("mean").alias("mean"))
    return member.select("service", F.explode(F.array(*[F.lit(x) for x in (0.5, 6.94, 20.82, 50.0)])).alias("rate"), "mean").select("service", "rate", F.round(F.col("mean") * F.col("rate"), 2).alias("tpm"))


@query("steps_merge", f"WITH {TOKENS_SQL} SELECT role AS step, count(*) AS calls, CAST(sum(prompt) AS BIGINT) AS prompt, CAST(sum(coalesce(completion, 0)) AS BIGINT) AS completion FROM u GROUP BY 1")
def steps_merge(spark: SparkSession, d: str) -> DataFrame:
    """Maps of step counters summed over chunks."""
    u = usage(spark, d).select(F.create_map("role", F.struct(F.lit(1).alias("calls"), "prompt", F.coalesce("completion", F.lit(0)).alias("completion"))).alias("steps"))
    e = u.select(F.explode("steps").alias("step", "s"))
    return e.groupBy("step").agg(F.sum("s.calls").alias("calls"), F.sum("s.prompt").alias("prompt"), F.sum("s.completion").alias("completion"))


@query("receipt_cost", f"WITH {TOKENS_SQL} SELECT model, round(sum(CASE WHEN model = 'm-small' THEN 0 ELSE prompt * 2e-6 + coalesce(completion, 0) * 1e-5 END), 6) AS usd FROM u GROUP BY 1")
def receipt_cost(spark: SparkSession, d: str) -> DataFrame:
    """Price times tokens; the local model is free."""
    usd = F.when(F.col("model") == "m-small", 0.0).otherwise(F.col("prompt") * 2e-6 + F.coalesce("completion", F.lit(0)) * 1e-5)
    return usage(spark, d).groupBy("model").agg(F.round(F.sum(usd), 6).alias("usd"))


@query("model_agreement", f"WITH {TOKENS_SQL} SELECT role AS service, count(DISTINCT model) = 1 AS agreed, min(split_part('hub/' || model, '/', 2)) AS name FROM u GROUP BY 1")
def model_agreement(spark: SparkSession, d: str) -> DataFrame:
    g = usage(spark, d).groupBy(F.col("role").alias("service")).agg(F.collect_set("model").alias("m"))
    return g.select("service", (F.size("m") == 1).alias("agreed"), F.expr("substring_index(concat('hub/', array_min(m)), '/', -1)").alias("name"))


@query("highest_profile", "SELECT p_brand AS family, max(p_size) AS version, p_brand || '@' || max(p_size) AS profile FROM part GROUP BY 1")
def highest_profile(spark: SparkSession, d: str) -> DataFrame:
    """By the number after '@', not by its text."""
    name = F.concat_ws("@", "p_brand", F.col("p_size").cast("string"))
    number = F.substring_index("p", "@", -1).cast("int")
    return load(spark, d, "part").select(F.col("p_brand").alias("family"), name.alias("p")).groupBy("family").agg(F.max(number).alias("version"), F.max_by("p", number).alias("profile"))


@query("check_coverage", "SELECT DISTINCT a.p_brand AS method FROM part a WHERE a.p_size < 25 AND a.p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 50)")
def check_coverage(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    return p.where("p_size < 25").select(F.col("p_brand").alias("method")).distinct().join(p.where("p_size = 50").select(F.col("p_brand").alias("method")), "method", "left_anti")


@query("queue_names", "SELECT DISTINCT replace(p_brand || '@' || p_size, '@', '-') || '.' || lower(split_part(p_type, ' ', 1)) AS queue FROM part")
def queue_names(spark: SparkSession, d: str) -> DataFrame:
    ref = F.concat_ws("@", "p_brand", F.col("p_size").cast("string"))
    return load(spark, d, "part").select(F.concat_ws(".", F.replace(ref, F.lit("@"), F.lit("-")), F.lower(F.substring_index("p_type", " ", 1))).alias("queue")).distinct()


@query("report_resend", "SELECT event_id, event_id % 12 AS resends, CAST(list_sum(list_transform(range(0, event_id % 12), lambda i: least(10, pow(2, i)))) AS DOUBLE) AS waited FROM events WHERE event_id % 12 > 0")
def report_resend(spark: SparkSession, d: str) -> DataFrame:
    """Waits of 1, 2, 4, 8, 10, 10 .. seconds."""
    n = (F.col("event_id") % 12).cast("int")
    waits = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.least(F.lit(10.0), F.pow(F.lit(2.0), i)))
    return load(spark, d, "events").where("event_id % 12 > 0").select("event_id", (F.col("event_id") % 12).alias("resends"), F.aggregate(waits, F.lit(0.0), lambda a, x: a + x).alias("waited"))


@query("stage_times", "SELECT user_id, round((min(epoch_us(ts)) FILTER (event_type = 'purchase') - min(epoch_us(ts)) FILTER (event_type = 'click')) / 1e6, 2) AS seconds FROM events GROUP BY 1")
def stage_times(spark: SparkSession, d: str) -> DataFrame:
    """First start to first success."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    first = [F.min(F.when(F.col("event_type") == k, us)) for k in ("purchase", "click")]
    return load(spark, d, "events").groupBy("user_id").agg(F.round((first[0] - first[1]) / 1e6, 2).alias("seconds"))


@query("activity_totals", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS longest, count(*) FILTER (value > 99) AS timeouts FROM events GROUP BY 1")
def activity_totals(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("longest"), F.count_if(F.col("value") > 99).alias("timeouts"))


@query("metric_series", "SELECT split_part(event_type, '{', 1) AS series, round(sum(value), 4) AS total FROM events WHERE event_type <> 'signup' GROUP BY 1")
def metric_series(spark: SparkSession, d: str) -> DataFrame:
    """Totals of a text exposition: name and value by pattern, creation series left out."""
    name = F.when(F.col("event_type") == "signup", F.concat("event_type", F.lit("_created"))).otherwise(F.col("event_type"))
    line = F.concat(name, F.lit('{source="'), F.col("user_id").cast("string"), F.lit('"} '), F.col("value").cast("string"))
    x = load(spark, d, "events").select(F.regexp_extract(line, r"^([a-z_]+)\{", 1).alias("series"), F.regexp_extract(line, r"\} (.*)$", 1).cast("double").alias("v"))
    return x.where(~F.col("series").endswith("_created")).groupBy("series").agg(F.round(F.sum("v"), 4).alias("total"))


@query("reuse_audit", "SELECT source, count(*) - count(DISTINCT sha256(text)) AS reused, count(DISTINCT sha256(text)) AS fresh, count(DISTINCT sha256(text)) = 0 AS all_reused FROM documents GROUP BY 1")
def reuse_audit(spark: SparkSession, d: str) -> DataFrame:
    fresh = F.count_distinct(F.sha2("text", 256))
    return load(spark, d, "documents").groupBy("source").agg((F.count("*") - fresh).alias("reused"), fresh.alias("fresh"), (fresh == 0).alias("all_reused"))


@query("run_digest", "WITH x AS (SELECT source, sha256(doc_id || '|' || lang || '|' || n_chars) AS h FROM documents) SELECT source, count(*) AS n, bit_xor(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS digest FROM x GROUP BY 1")
def run_digest(spark: SparkSession, d: str) -> DataFrame:
    """An order-free digest of a run's rows without the fields that differ from run to run."""
    h = F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), "lang", F.col("n_chars").cast("string")), 256)
    return load(spark, d, "documents").select("source", h.alias("h")).groupBy("source").agg(F.count("*").alias("n"), F.bit_xor(F.conv(F.substring("h", 1, 15), 16, 10).cast("long")).alias("digest"))


@query("run_diff", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'lost' WHEN a.doc_id IS NULL THEN 'gained' ELSE 'changed' END AS what FROM (SELECT doc_id, lang FROM documents WHERE doc_id % 5 <> 0) a FULL JOIN (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 7 <> 0) b USING (doc_id) WHERE a.lang IS DISTINCT FROM b.lang")
def run_diff(spark: SparkSession, d: str) -> DataFrame:
    """Gained, lost and changed places between two runs."""
    docs = load(spark, d, "documents")
    a = docs.where("doc_id % 5 <> 0").select("doc_id", F.col("lang").alias("a"))
    b = docs.where("doc_id % 7 <> 0").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "xx").otherwise(F.col("lang")).alias("b"))
    both = a.join(b, "doc_id", "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("doc_id", F.when(F.col("b").isNull(), "lost").when(F.col("a").isNull(), "gained").otherwise("changed").alias("what"))


@query("json_paths_diff", "WITH p AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events), q AS (SELECT user_id, k, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS prev, event_id FROM p) SELECT event_id, '$.k' AS path, prev AS old, k AS new FROM q WHERE prev IS NOT NULL AND prev <> k")
def json_paths_diff(spark: SparkSession, d: str) -> DataFrame:
    """Leaf paths whose values differ from the run before."""
    m = F.from_json("props", "map<string,long>")
    leaves = load(spark, d, "events").select("event_id", "user_id", F.explode(m).alias("key", "new"))
    prev = F.lag("new").over(Window.partitionBy("user_id", "key").orderBy("event_id"))
    return leaves.withColumn("old", prev).where("old is not null and old <> new").select("event_id", F.concat(F.lit("$."), "key").alias("path"), "old", "new")


@query("unique_keys", "SELECT 'orders' AS t, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders UNION ALL SELECT 'lineitem', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem")
def unique_keys(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").agg(F.lit("orders").alias("t"), (F.count("*") == F.count_distinct("o_orderkey")).alias("is_unique"))
    li = load(spark, d, "lineitem").agg(F.lit("lineitem").alias("t"), (F.count("*") == F.count_distinct("l_orderkey", "l_linenumber")).alias("is_unique"))
    return o.union(li)


@query("released_guard", "SELECT p_partkey, CASE WHEN p_size < prev THEN 'LOWER_VERSION' WHEN p_size = prev AND p_type <> prev_type THEN 'CHANGED_WITHOUT_VERSION' END AS error FROM (SELECT *, lag(p_size) OVER w AS prev, lag(p_type) OVER w AS prev_type FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)) WHERE prev IS NOT NULL")
def released_guard(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    x = load(spark, d, "part").withColumns({"prev": F.lag("p_size").over(w), "prev_type": F.lag("p_type").over(w)}).where("prev is not null")
    return x.select("p_partkey", F.when(F.col("p_size") < F.col("prev"), "LOWER_VERSION").when((F.col("p_size") == F.col("prev")) & (F.col("p_type") != F.col("prev_type")), "CHANGED_WITHOUT_VERSION").alias("error"))


@query("receipt_table_union", "WITH m AS (SELECT unnest(['click', 'view', 'retry']) AS method UNION SELECT DISTINCT event_type FROM events) SELECT m.method, count(e.event_id) AS receipts FROM m LEFT JOIN events e ON e.event_type = m.method GROUP BY 1")
def receipt_table_union(spark: SparkSession, d: str) -> DataFrame:
    """Listed and seen methods, those without receipts too."""
    e = load(spark, d, "events")
    listed = spark.createDataFrame([("click",), ("view",), ("retry",)], "method string")
    seen = e.groupBy(F.col("event_type").alias("method")).agg(F.count("*").alias("n"))
    return listed.union(seen.select("method")).distinct().join(seen, "method", "left").select("method", F.coalesce("n", F.lit(0)).alias("receipts"))


@query("attempts_histogram", "SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '3' WHEN n <= 6 THEN '6' ELSE '+Inf' END AS le, count(*) AS items FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) GROUP BY 1")
def attempts_histogram(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(F.col("n") <= 1, "1").when(F.col("n") <= 3, "3").when(F.col("n") <= 6, "6").otherwise("+Inf").alias("le")).agg(F.count("*").alias("items"))
