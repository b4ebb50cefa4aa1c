"""Study builders and audits: cases and pairs, resend folds, request equality, summary shape, selection by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions.codecs import squeezed
from quillfold.operators.evals import SCORES_SQL, auroc, scored
from quillfold.registry import query
from quillfold.sources.tables import FEED_SQL, feed, load


@query(
    "snapshot_page_dedup",
    f"WITH {FEED_SQL} SELECT source_id, document_uid, kind, position FROM feed QUALIFY row_number() OVER (PARTITION BY source_id, document_uid ORDER BY kind = 'view' DESC, position) = 1",
)
def snapshot_page_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Of a key's rows in a snapshot the pending one (view) wins, else the first; later duplicates are ignored."""
    k = F.row_number().over(Window.partitionBy("source_id", "document_uid").orderBy(F.desc(F.col("kind") == "view"), "position"))
    return feed(spark, d).withColumn("k", k).where("k = 1").select("source_id", "document_uid", "kind", "position")


@query(
    "unit_cases",
    "WITH u AS (SELECT conv_id, turn, trim(s) AS s FROM (SELECT conv_id, turn, unnest(string_split(text, '. ')) AS s FROM conversations)) SELECT conv_id, turn, count(*) FILTER (s <> '') AS entered, count(*) FILTER (length(s) > 40) AS final, CAST(sum(length(s)) AS BIGINT) AS prompt_chars FROM u GROUP BY 1, 2",
)
def unit_cases(spark: SparkSession, d: str) -> DataFrame:
    """Units from nested fates: sentences that entered and that were kept, and the prompt's length."""
    u = load(spark, d, "conversations").select("conv_id", "turn", F.explode(F.split("text", r"\. ", -1)).alias("s")).withColumn("s", F.trim("s"))
    return u.groupBy("conv_id", "turn").agg(F.count_if(F.col("s") != "").alias("entered"), F.count_if(F.length("s") > 40).alias("final"), F.sum(F.length("s")).alias("prompt_chars"))


@query(
    "control_pairing",
    "WITH c AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY sha256(conv_id || '/' || turn)) AS k FROM conversations) SELECT a.conv_id, a.turn AS original, a.turn + 1000 AS planted, b.turn AS control FROM c a JOIN c b ON b.conv_id = a.conv_id AND b.k = a.k % a.n + 1 WHERE b.turn <> a.turn",
)
def control_pairing(spark: SparkSession, d: str) -> DataFrame:
    """Each original with its plant and, as control, another section of the same case: the next in hash order."""
    w = Window.partitionBy("conv_id").orderBy(F.sha2(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")), 256))
    whole = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c = load(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("k"))
    nxt = F.coalesce(F.lead("turn").over(Window.partitionBy("conv_id").orderBy("k")), F.first("turn").over(whole))
    p = c.select("conv_id", F.col("turn").alias("original"), (F.col("turn") + 1000).alias("planted"), nxt.alias("control"))
    return p.where("control <> original")


@query(
    "resend_fold",
    "WITH s AS (SELECT conv_id, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS tokens, count(*) FILTER (role = 'user') AS repaired FROM conversations GROUP BY 1) SELECT conv_id, least(calls, repaired + 1) AS calls, tokens FROM s",
)
def resend_fold(spark: SparkSession, d: str) -> DataFrame:
    """Calls count as many as there are repaired sentences, and one; tokens are kept as they were."""
    s = load(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("calls"), F.sum(F.length("text")).alias("tokens"), F.count_if(F.col("role") == "user").alias("repaired"))
    return s.select("conv_id", F.least("calls", F.col("repaired") + 1).alias("calls"), "tokens")


@query(
    "request_equality",
    "SELECT d.lang AS category, d.doc_id % 2 AS split, count(*) AS n, count(*) FILTER (d.source IS NOT DISTINCT FROM e.source) AS same_source, count(*) FILTER (d.lang IS NOT DISTINCT FROM e.lang) AS same_lang, count(*) FILTER (d.n_chars IS NOT DISTINCT FROM e.n_chars) AS same_size FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 20 GROUP BY 1, 2",
)
def request_equality(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a request that equal those of the run before, counted by category and split."""
    docs = load(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    e = docs.select((F.col("doc_id") - 20).alias("doc_id"), *[F.col(c).alias(f"e_{c}") for c in ("source", "lang", "n_chars")])
    same = {"same_source": "source", "same_lang": "lang", "same_size": "n_chars"}
    counts = [F.count_if(F.col(c).eqNullSafe(F.col(f"e_{c}"))).alias(name) for name, c in same.items()]
    return docs.join(e, "doc_id").groupBy(F.col("lang").alias("category"), (F.col("doc_id") % 2).alias("split")).agg(F.count("*").alias("n"), *counts)


@query(
    "chart_labels",
    "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE trim(regexp_replace(p_type || ' (note)', '\\s*\\([^)]*\\)$', '')) END AS x, CASE WHEN p_size % 2 = 0 THEN trim(regexp_replace(p_type || ' (note)', '\\s*\\([^)]*\\)$', '')) ELSE p_brand END AS category FROM part",
)
def chart_labels(spark: SparkSession, d: str) -> DataFrame:
    """A closing note is stripped from labels; axis and category change places where a chart has them swapped."""
    label = F.trim(F.regexp_replace(F.concat("p_type", F.lit(" (note)")), r"\s*\([^)]*\)$", ""))
    swapped = F.col("p_size") % 2 == 0
    return load(spark, d, "part").select("p_partkey", F.when(swapped, F.col("p_brand")).otherwise(label).alias("x"), F.when(swapped, label).otherwise(F.col("p_brand")).alias("category"))


@query(
    "summary_shape",
    "WITH c AS (SELECT conv_id, turn, length(text) AS n, turn > lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS up FROM conversations) SELECT conv_id, count(*) FILTER (n >= 300) AS kept, count(*) FILTER (n BETWEEN 100 AND 299) AS rewritten, count(*) FILTER (n < 100) AS dropped, coalesce(bool_and(up), true) AS in_reading_order, max(turn) < 2 * count(*) AS cites_only_summarized FROM c GROUP BY 1",
)
def summary_shape(spark: SparkSession, d: str) -> DataFrame:
    """Counts by fate, and two audits: sections in reading order, and citations of summarised sections only."""
    n = F.length("text")
    c = load(spark, d, "conversations").select("conv_id", "turn", n.alias("n"), (F.col("turn") > F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn"))).alias("up"))
    return c.groupBy("conv_id").agg(F.count_if(F.col("n") >= 300).alias("kept"), F.count_if(F.col("n").between(100, 299)).alias("rewritten"), F.count_if(F.col("n") < 100).alias("dropped"), F.coalesce(F.bool_and("up"), F.lit(True)).alias("in_reading_order"), (F.max("turn") < 2 * F.count("*")).alias("cites_only_summarized"))


@query(
    "side_by_side",
    "SELECT a.p_partkey, a.p_type AS now, b.p_type AS alone FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 WHERE a.p_type IS DISTINCT FROM b.p_type",
)
def side_by_side(spark: SparkSession, d: str) -> DataFrame:
    """Rows that differ between two runs by key."""
    p = load(spark, d, "part").select("p_partkey", F.col("p_type").alias("now"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("now").alias("alone"))
    return p.join(b, "p_partkey").where(~F.col("now").eqNullSafe(F.col("alone")))


@query(
    "activity_spans",
    "SELECT event_type, min(epoch_us(ts)) AS first_scheduled_us, max(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) AS last_closed_us FROM events GROUP BY 1",
)
def activity_spans(spark: SparkSession, d: str) -> DataFrame:
    """First scheduled to last closed, a type."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return load(spark, d, "events").groupBy("event_type").agg(F.min(us).alias("first_scheduled_us"), F.max(us + F.round(F.col("value") * 1_000_000).cast("long")).alias("last_closed_us"))


@query(
    "verdict_resolution",
    "WITH r AS (SELECT sha256(regexp_replace(text, '\\s+', '', 'g')) AS h, min(item_id) AS item FROM benchmark GROUP BY 1), x AS (SELECT conv_id, turn, length(trim(text)) = 0 AS missing, sha256(regexp_replace(text, '\\s+', '', 'g')) AS h, role FROM conversations) SELECT conv_id, turn, CASE WHEN missing THEN 'FAIL' WHEN r.item IS NOT NULL THEN 'RECORDED' WHEN role = 'assistant' THEN 'JUDGED' ELSE 'PENDING' END AS verdict FROM x LEFT JOIN r USING (h)",
)
def verdict_resolution(spark: SparkSession, d: str) -> DataFrame:
    """A missing answer fails, one as recorded keeps the recorded verdict, others are judged or pending."""
    r = load(spark, d, "benchmark").groupBy(F.sha2(squeezed(F.col("text")), 256).alias("h")).agg(F.min("item_id").alias("item"))
    x = load(spark, d, "conversations").select("conv_id", "turn", "role", (F.length(F.trim("text")) == 0).alias("missing"), F.sha2(squeezed(F.col("text")), 256).alias("h"))
    verdict = F.when(F.col("missing"), "FAIL").when(F.col("item").isNotNull(), "RECORDED").when(F.col("role") == "assistant", "JUDGED").otherwise("PENDING")
    return x.join(r, "h", "left").select("conv_id", "turn", verdict.alias("verdict"))


@query(
    "group_selection",
    f"WITH {SCORES_SQL}, g AS (SELECT grp, count(*) AS n, sum(y) AS e FROM s GROUP BY 1) SELECT grp, n, CAST(e AS BIGINT) AS errors, CASE WHEN e = 0 OR e = n THEN 'ONE_CLASS' WHEN n < 10 THEN 'FEW_UNITS' ELSE 'fit' END AS selected FROM g",
)
def group_selection(spark: SparkSession, d: str) -> DataFrame:
    """What each group can be fitted for: one class or too few units leave it out."""
    g = auroc(scored(spark, d), "grp")
    one = (F.col("positives") == 0) | (F.col("positives") == F.col("units"))
    return g.select("grp", F.col("units").alias("n"), F.col("positives").cast("long").alias("errors"), F.when(one, "ONE_CLASS").when(F.col("units") < 10, "FEW_UNITS").otherwise("fit").alias("selected"))
