"""Document and text operators: screening, file signatures, sections, chunks, sentences, answers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions import rules
from quillfold.functions import text as t
from quillfold.functions.codecs import bucket_and_key, html_escaped, squeezed
from quillfold.registry import query
from quillfold.sources.tables import load


@query("section_targets", "SELECT doc_id, CASE WHEN n < 500 THEN 0 ELSE least(8, CAST(ceil(n / 1500.0) AS INTEGER)) END AS section_target, greatest(5, least(15, CAST(round_even(n / 8000.0, 0) AS INTEGER))) AS overview_target FROM (SELECT doc_id, length(text) AS n FROM documents)")
def section_targets(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    return load(spark, d, "documents").select("doc_id", t.section_target(n).alias("section_target"), t.overview_target(n).alias("overview_target"))


SECTION_SQL = r"""l AS (SELECT doc_id, i, line, len(line) <= 40 AND line <> '' AS is_heading FROM (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS line FROM documents)),
    s AS (SELECT *, sum(CASE WHEN is_heading THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS section FROM l),
    g AS (SELECT doc_id, CAST(section AS BIGINT) AS section, coalesce(max(line) FILTER (is_heading), '#/body') AS heading, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT is_heading), '') AS body FROM s GROUP BY 1, 2)"""


def sections(docs: DataFrame) -> DataFrame:
    """Headings (here: short lines) open sections; what stands before the first is the body's own section."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    is_heading = (F.length("line") <= 40) & (F.col("line") != "")
    numbered = lines.withColumn("is_heading", is_heading).withColumn("section", F.sum(F.col("is_heading").cast("long")).over(Window.partitionBy("doc_id").orderBy("i")))
    body = F.array_sort(F.collect_list(F.when(~F.col("is_heading"), F.struct("i", "line"))))
    out = numbered.groupBy("doc_id", "section").agg(F.max(F.when(F.col("is_heading"), F.col("line"))).alias("heading"), body.alias("lines"))
    return out.select("doc_id", "section", F.coalesce("heading", F.lit("#/body")).alias("heading"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("body"))


@query("sectioning", f"WITH {SECTION_SQL} SELECT doc_id, section, heading, sha256(body) AS body_sha256 FROM g")
def sectioning(spark: SparkSession, d: str) -> DataFrame:
    return sections(load(spark, d, "documents")).select("doc_id", "section", "heading", F.sha2("body", 256).alias("body_sha256"))


@query("skip_reasons", f"WITH {SECTION_SQL}, h AS (SELECT *, lower(trim(regexp_replace(regexp_replace(heading, '^\\s*(?:[0-9]+(?:\\.[0-9]+)*|[IVXLC]+|[A-Z])[.):]?\\s+', ''), '[\\s.:;,]+$', ''))) AS name FROM g) SELECT doc_id, section, name, CASE WHEN trim(body) = '' THEN 'EMPTY' WHEN name IN ('references', 'bibliography', 'works cited', 'literature cited', 'references and notes', '參考文獻', '参考文献', '參考資料') THEN 'REFERENCES' WHEN starts_with(name, 'acknowledg') OR starts_with(name, '致謝') OR starts_with(name, '致谢') OR starts_with(name, '誌謝') THEN 'ACKNOWLEDGEMENTS' END AS reason FROM h")
def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    return sections(load(spark, d, "documents")).select("doc_id", "section", t.heading(F.col("heading")).alias("name"), t.skip_reason(F.col("heading"), F.col("body")).alias("reason"))


@query(
    "chunk_pack",
    """WITH g AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: CAST(length(x) AS BIGINT)) AS sizes FROM documents),
    f AS (SELECT doc_id, list_reduce(list_transform(sizes, lambda n: {'chunk': CAST(0 AS BIGINT), 'fill': n, 'out': CAST([] AS BIGINT[])}),
      lambda a, b: {'chunk': a.chunk + CASE WHEN a.chunk = 0 OR a.fill + b.fill > 800 THEN 1 ELSE 0 END, 'fill': CASE WHEN a.chunk = 0 OR a.fill + b.fill > 800 THEN b.fill ELSE a.fill + b.fill END, 'out': list_append(a.out, a.chunk + CASE WHEN a.chunk = 0 OR a.fill + b.fill > 800 THEN 1 ELSE 0 END)},
      {'chunk': CAST(0 AS BIGINT), 'fill': CAST(0 AS BIGINT), 'out': CAST([] AS BIGINT[])}) AS r FROM g)
    SELECT doc_id, len(r.out) AS sections, r.chunk AS chunks, array_to_string(r.out, ',') AS numbers FROM f""",
)
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive sections (here: lines) of a document packed into chunks of at most 800, never split."""
    sizes = F.transform(F.split("text", "\n", -1), lambda x: F.length(x).cast("long"))
    packed = load(spark, d, "documents").select("doc_id", t.pack_chunks(sizes, 800).alias("out"))
    return packed.select("doc_id", F.size("out").cast("long").alias("sections"), F.array_max("out").cast("long").alias("chunks"), F.array_join("out", ",").alias("numbers"))


@query("sentence_test", "SELECT conv_id, turn, len(regexp_extract_all(text, '[^\\s]+')) >= 3 AND regexp_matches(text, '\\p{L}') AS sentence FROM conversations")
def sentence_test(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversations").select("conv_id", "turn", t.is_sentence(F.col("text")).alias("sentence"))


@query("map_acceptance", "WITH a AS (SELECT conv_id, turn, text FROM conversations WHERE trim(text) <> '' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1) SELECT conv_id, turn, len(string_split(text, '. ')) AS sentences, least(4, len(list_filter(string_split(text, '. '), lambda x: trim(x) <> ''))) AS kept FROM a")
def map_acceptance(spark: SparkSession, d: str) -> DataFrame:
    """The first non-blank answer of a section, its blank sentences left out, cut to the target."""
    a = load(spark, d, "conversations").where(F.trim("text") != "").withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))).where("k = 1")
    parts = F.split("text", r"\. ", -1)
    kept = F.slice(F.filter(parts, lambda x: F.trim(x) != ""), 1, 4)
    return a.select("conv_id", "turn", F.size(parts).cast("long").alias("sentences"), F.size(kept).cast("long").alias("kept"))


@query("verdict_parse", "SELECT conv_id, list_sort(list(turn)) = range(min(turn), min(turn) + count(*)) AS complete, count(*) AS verdicts FROM conversations GROUP BY 1")
def verdict_parse(spark: SparkSession, d: str) -> DataFrame:
    """Verdict numbers must be exactly the run that was asked for."""
    g = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("n"), F.min("turn").alias("first"), F.count("*").alias("verdicts"))
    return g.select("conv_id", (F.col("n") == F.sequence("first", F.col("first") + F.col("verdicts") - 1)).alias("complete"), "verdicts")


@query("sentence_fates", "WITH x AS (SELECT c.conv_id, c.turn, c.text, n.text AS answer FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1) SELECT conv_id, turn, CASE WHEN answer IS NULL THEN 'dropped:NO_VERDICT' WHEN length(answer) >= length(text) THEN 'supported' WHEN length(answer) > 100 THEN 'rewritten' ELSE 'dropped:UNSUPPORTED' END AS fate FROM x")
def sentence_fates(spark: SparkSession, d: str) -> DataFrame:
    """Each statement against the verdict that follows it: supported, rewritten or dropped with a reason."""
    c = load(spark, d, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    n, m = F.length("answer"), F.length("text")
    fate = F.when(F.col("answer").isNull(), "dropped:NO_VERDICT").when(n >= m, "supported").when(n > 100, "rewritten").otherwise("dropped:UNSUPPORTED")
    return c.join(nxt, ["conv_id", "turn"], "left").select("conv_id", "turn", fate.alias("fate"))


@query("overview_sources", "WITH s AS (SELECT conv_id, turn, unnest([turn - 1, turn, turn + 3, turn]) AS cited FROM conversations), k AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1) SELECT s.conv_id, s.turn, array_to_string(list_sort(list_distinct(list(cited))), ',') AS sources FROM s JOIN k USING (conv_id) WHERE cited BETWEEN 0 AND last GROUP BY 1, 2")
def overview_sources(spark: SparkSession, d: str) -> DataFrame:
    """The sections that a statement cites: out-of-range numbers ignored, distinct, sorted."""
    c = load(spark, d, "conversations")
    k = F.max("turn").over(Window.partitionBy("conv_id"))
    cited = F.array(F.col("turn") - 1, F.col("turn"), F.col("turn") + 3, F.col("turn"))
    x = c.withColumn("last", k).select("conv_id", "turn", F.array_sort(F.array_distinct(F.filter(cited, lambda v: (v >= 0) & (v <= F.col("last"))))).alias("s"))
    return x.where(F.size("s") > 0).select("conv_id", "turn", F.array_join("s", ",").alias("sources"))


@query("prompt_rendering", "SELECT conv_id, turn, '<section heading=\"' || replace(replace(replace(replace(role || ' & \"' || turn || '\"', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') || '\">' || chr(10) || text || chr(10) || '</section>' AS prompt FROM conversations")
def prompt_rendering(spark: SparkSession, d: str) -> DataFrame:
    name = html_escaped(F.concat(F.col("role"), F.lit(' & "'), F.col("turn").cast("string"), F.lit('"')))
    return load(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit('<section heading="'), name, F.lit('">\n'), F.col("text"), F.lit("\n</section>")).alias("prompt"))


@query("repair_gate", "WITH f AS (SELECT conv_id, arg_min(text, turn) AS first, count(*) AS answers FROM conversations GROUP BY 1) SELECT conv_id, CASE WHEN trim(first) = '' THEN 'empty' WHEN len(regexp_extract_all(first, '[^\\s]+')) >= 3 AND regexp_matches(first, '\\p{L}') THEN 'accept' ELSE 'repair' END AS gate, answers FROM f")
def repair_gate(spark: SparkSession, d: str) -> DataFrame:
    f = load(spark, d, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("first"), F.count("*").alias("answers"))
    return f.select("conv_id", F.when(F.trim("first") == "", "empty").when(t.is_sentence(F.col("first")), "accept").otherwise("repair").alias("gate"), "answers")


@query("identifiers", "SELECT p_partkey, regexp_full_match(replace(lower(p_type), ' ', '_'), '[A-Za-z0-9]+(?:[_./-][A-Za-z0-9]+)+') AS identifier, regexp_full_match(p_name, '[A-Za-z0-9]+(?:[_./-][A-Za-z0-9]+)+') AS name_identifier FROM part")
def identifiers(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", t.is_identifier(F.replace(F.lower("p_type"), F.lit(" "), F.lit("_"))).alias("identifier"), t.is_identifier(F.col("p_name")).alias("name_identifier"))


@query("trailing_space", "SELECT doc_id, sha256(array_to_string(list_transform(string_split(text, chr(10)), lambda x: rtrim(x, ' ')), chr(10))) AS code_sha256 FROM documents")
def trailing_space(spark: SparkSession, d: str) -> DataFrame:
    stripped = F.array_join(F.transform(F.split("text", "\n", -1), lambda x: F.rtrim(x)), "\n")
    return load(spark, d, "documents").select("doc_id", F.sha2(stripped, 256).alias("code_sha256"))


@query("equation_numbers", "SELECT conv_id, turn, regexp_replace(text || ' (' || turn || '.1a)', '\\s*\\([0-9]+(\\.[0-9]+)*[a-z]?\\)\\s*$', '') = rtrim(text) AS stripped FROM conversations")
def equation_numbers(spark: SparkSession, d: str) -> DataFrame:
    tagged = F.concat("text", F.lit(" ("), F.col("turn").cast("string"), F.lit(".1a)"))
    return load(spark, d, "conversations").select("conv_id", "turn", (F.regexp_replace(tagged, r"\s*\([0-9]+(\.[0-9]+)*[a-z]?\)\s*$", "") == F.rtrim("text")).alias("stripped"))


@query("squeezed_answers", "SELECT sha256(regexp_replace(text, '\\s+', '', 'g')) AS answer, count(*) AS times, min(item_id) AS first FROM benchmark GROUP BY 1")
def squeezed_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers that are equal but for white space are judged once."""
    return load(spark, d, "benchmark").groupBy(F.sha2(squeezed(F.col("text")), 256).alias("answer")).agg(F.count("*").alias("times"), F.min("item_id").alias("first"))


@query("plant_validity", "SELECT c.conv_id, c.turn, c.text <> coalesce(n.text, '') AND NOT starts_with(coalesce(n.text, ''), 'I cannot') AND n.text IS NOT NULL AS valid FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1")
def plant_validity(spark: SparkSession, d: str) -> DataFrame:
    """A planted change counts if it changed the text and is no refusal."""
    c = load(spark, d, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("new"))
    x = c.join(nxt, ["conv_id", "turn"], "left")
    return x.select("conv_id", "turn", (F.col("new").isNotNull() & F.coalesce(F.col("text") != F.col("new"), F.lit(False)) & ~F.coalesce(F.col("new").startswith("I cannot"), F.lit(False))).alias("valid"))


# What must not be published. A placeholder's braces are looked for without a command's arguments.
PLACEHOLDER = r"\{([A-Z][A-Z0-9_]*|#[0-9A-Z_]+)\}"
BRACED = r"(\\[A-Za-z]+|[$^_])(\{[^{}]*\})+"
LOCAL_PATH = r"(/Users/[^/\s]+/|/home/[^/\s]+/|/private/(tmp|var)/|/var/folders/)"
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
HOST = r"(?m)[A-Za-z0-9-]+\.local([^A-Za-z0-9.]|$)"
SECRET = r"(?m)(^|[^A-Za-z0-9_-])(AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|-----BEGIN [A-Z ]*PRIVATE KEY-----)"
# end of fixed values
#: Addresses that may be published; a deployment adds its own.
EMAIL_OK = r"(@users\.noreply\.github\.com|@example\.(com|org|net)|@[0-9]+\.ya?ml)$"


@query("publish_screen", f"SELECT doc_id, regexp_matches(regexp_replace(text, '{BRACED}', '', 'g'), '{PLACEHOLDER}') AS placeholder, regexp_matches(text, '{LOCAL_PATH}') AS local_path, CAST(len(list_filter(regexp_extract_all(text, '{EMAIL}'), lambda x: NOT regexp_matches(x, '{EMAIL_OK}'))) AS BIGINT) AS emails, regexp_matches(text, '{HOST}') AS hostname, regexp_matches(text, '{SECRET}') AS secret FROM documents")
def publish_screen(spark: SparkSession, d: str, allowed: str = EMAIL_OK) -> DataFrame:
    """What must not be published: placeholders, local paths, addresses off the allow-list, host names, keys.

    Each long pattern is held to the texts in which a plain search finds what it needs.
    """
    text = F.col("text")
    mail = F.when(text.contains("@"), F.regexp_extract_all("text", F.lit(EMAIL), F.lit(0))).otherwise(F.array().cast("array<string>"))
    marks = [text.contains(x) for x in ("AKIA", "ghp_", "github_pat_", "sk-", "xox", "-----BEGIN ")]
    key = marks[0]
    for m in marks[1:]:
        key = key | m
    return load(spark, d, "documents").select(
        "doc_id",
        (text.contains("{") & F.regexp_replace("text", BRACED, "").rlike(PLACEHOLDER)).alias("placeholder"),
        (text.contains("/") & text.rlike(LOCAL_PATH)).alias("local_path"),
        F.size(F.filter(mail, lambda x: ~x.rlike(allowed))).cast("long").alias("emails"),
        (text.contains(".local") & text.rlike(HOST)).alias("hostname"),
        (key & text.rlike(SECRET)).alias("secret"),
    )


@query("media_type_detect", "SELECT page_id, CASE WHEN contains(substr(html, 1, 1024), '%PDF-') THEN 'application/pdf' WHEN starts_with(html, 'GIF8') THEN 'image/gif' WHEN starts_with(html, 'PK') THEN 'application/zip' WHEN regexp_matches(html, '(?i)^\\s*<(!doctype|html)') THEN 'text/html' ELSE 'application/octet-stream' END AS media_type FROM pages")
def media_type_detect(spark: SparkSession, d: str) -> DataFrame:
    """By signature; a PDF's may stand anywhere in the first 1024 bytes."""
    h = F.col("html")
    kind = F.when(F.substring(h, 1, 1024).contains("%PDF-"), "application/pdf").when(h.startswith("GIF8"), "image/gif").when(h.startswith("PK"), "application/zip").when(h.rlike(r"(?i)^\s*<(!doctype|html)"), "text/html").otherwise("application/octet-stream")
    return load(spark, d, "pages").select("page_id", kind.alias("media_type"))


@query("url_parts", "SELECT page_id, regexp_extract(u, '^s3://([^/?#]+)/', 1) AS bucket, regexp_extract(u, '^s3://[^/?#]+/(.*)$', 1) AS key, regexp_matches(u, '^s3://[^/?#]+/[^?#]+$') AS valid FROM (SELECT page_id, regexp_replace(url, '^https?', 's3') AS u FROM pages)")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    bucket, key, ok = bucket_and_key(F.regexp_replace("url", "^https?", "s3"))
    return load(spark, d, "pages").select("page_id", bucket.alias("bucket"), key.alias("key"), ok.alias("valid"))


@query("digest_check", "SELECT page_id, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS size, CASE WHEN page_id % 9 = 0 THEN 'DIGEST' WHEN strlen(html) > 4000 THEN 'SIZE' END AS error FROM pages")
def digest_check(spark: SparkSession, d: str) -> DataFrame:
    """Received bytes against what was declared: digest first, then size."""
    p = load(spark, d, "pages").withColumn("sha256", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    declared = F.when(F.col("page_id") % 9 == 0, F.lit("0" * 64)).otherwise(F.col("sha256"))
    return p.select("page_id", "sha256", "size", rules.first_failure((F.col("sha256") != declared, "DIGEST"), (F.col("size") > 4000, "SIZE")).alias("error"))


@query("item_validation", "SELECT page_id, CASE WHEN NOT regexp_full_match('page-' || page_id, '[A-Za-z0-9][A-Za-z0-9._:-]{0,127}') THEN 'id' WHEN regexp_matches(url, '\\.\\.|^/') THEN 'path' WHEN length(url) > 60 THEN 'length' WHEN strlen(html) > 6000 THEN 'size' END AS reason FROM pages")
def item_validation(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "pages")
    reason = rules.first_failure(
        (~F.concat(F.lit("page-"), F.col("page_id").cast("string")).rlike(rules.DOCUMENT_ID), "id"),
        (F.col("url").rlike(r"\.\.|^/"), "path"),
        (F.length("url") > 60, "length"),
        (F.octet_length("html") > 6000, "size"),
    )
    return p.select("page_id", reason.alias("reason"))


@query("metadata_limits", "SELECT event_id, regexp_full_match(event_type, '[a-z][a-z0-9_]{0,63}') AND length(props) <= 512 AND strlen(props) <= 8192 AS valid FROM events")
def metadata_limits(spark: SparkSession, d: str) -> DataFrame:
    """Keys by pattern, values by length, all by bytes of JSON."""
    m = F.create_map("event_type", "props")
    ok = (F.size(m) <= 50) & F.forall(F.map_keys(m), lambda k: k.rlike(rules.METADATA_KEY)) & F.forall(F.map_values(m), lambda v: F.length(v) <= 512) & (F.octet_length(F.to_json(m)) <= 8192)
    return load(spark, d, "events").select("event_id", ok.alias("valid"))


@query("traceparent", "SELECT event_id, regexp_extract(tp, '^00-([0-9a-f]{32})-([0-9a-f]{16})-[0-9a-f]{2}$', 1) AS trace_id, regexp_matches(tp, '^00-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}$') AND tp NOT LIKE '00-00000000000000000000000000000000-%' AS valid FROM (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '00-' || repeat('0', 32) || '-0000000000000001-01' WHEN event_id % 7 = 0 THEN 'bad' ELSE '00-' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 32) || '-' || substr(sha256(CAST(event_id AS VARCHAR)), 33, 16) || '-01' END AS tp FROM events)")
def traceparent(spark: SparkSession, d: str) -> DataFrame:
    h = F.sha2(F.col("event_id").cast("string"), 256)
    tp = F.when(F.col("event_id") % 50 == 0, F.lit("00-" + "0" * 32 + "-0000000000000001-01")).when(F.col("event_id") % 7 == 0, "bad").otherwise(F.concat(F.lit("00-"), F.substring(h, 1, 32), F.lit("-"), F.substring(h, 33, 16), F.lit("-01")))
    x = load(spark, d, "events").select("event_id", tp.alias("tp"))
    ok = F.col("tp").rlike(r"^00-(?!0{32})[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}$")
    return x.select("event_id", F.regexp_extract("tp", r"^00-([0-9a-f]{32})-([0-9a-f]{16})-[0-9a-f]{2}$", 1).alias("trace_id"), ok.alias("valid"))


@query("access_redaction", "SELECT page_id, regexp_replace('PUT /v1/batches/' || page_id || '/files/' || url || ' 200', '(/files/)[^ ]+', '\\1[path]') AS line FROM pages")
def access_redaction(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("PUT /v1/batches/"), F.col("page_id").cast("string"), F.lit("/files/"), F.col("url"), F.lit(" 200"))
    return load(spark, d, "pages").select("page_id", F.regexp_replace(line, "(/files/)[^ ]+", "$1[path]").alias("line"))


@query("header_validation", "SELECT p_partkey, regexp_full_match(p_brand, '[!#$%&''*+.^_`|~0-9A-Za-z-]+') AS token, regexp_full_match(p_type, '[ -~]*') AS printable FROM part")
def header_validation(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", F.col("p_brand").rlike(r"^[!#$%&'*+.^_`|~0-9A-Za-z-]+$").alias("token"), F.col("p_type").rlike(r"^[ -~]*$").alias("printable"))


@query("inline_content", "SELECT doc_id, CASE WHEN strlen(text) <= 16384 THEN sha256(text) END AS inline_sha256 FROM documents")
def inline_content(spark: SparkSession, d: str) -> DataFrame:
    """Content above the inline limit is left out of the projection."""
    return load(spark, d, "documents").select("doc_id", F.when(F.octet_length("text") <= t.INLINE_BYTES, F.sha2("text", 256)).alias("inline_sha256"))


@query("preflight_limits", "SELECT doc_id, CASE WHEN strlen(text) > 30000 THEN 'BYTES' WHEN n_chars / 1800 > 8 THEN 'PAGES' WHEN (doc_id % 40) * (doc_id % 30) * 4 > 4000 THEN 'PIXELS' END AS limit_hit FROM documents")
def preflight_limits(spark: SparkSession, d: str) -> DataFrame:
    pixels = (F.col("doc_id") % 40) * (F.col("doc_id") % 30) * 4
    return load(spark, d, "documents").select("doc_id", rules.first_failure((F.octet_length("text") > 30000, "BYTES"), (F.col("n_chars") / 1800 > 8, "PAGES"), (pixels > 4000, "PIXELS")).alias("limit_hit"))


@query("key_prefix_list", "SELECT key, size FROM (SELECT 'pages/' || source || '/' || doc_id || '/record.json' AS key, n_chars AS size FROM documents) WHERE starts_with(key, 'pages/src1/') ORDER BY key")
def key_prefix_list(spark: SparkSession, d: str) -> DataFrame:
    """All keys under a strict prefix, sorted."""
    key = F.concat_ws("/", F.lit("pages"), "source", F.col("doc_id").cast("string"), F.lit("record.json"))
    return load(spark, d, "documents").select(key.alias("key"), F.col("n_chars").alias("size")).where(F.col("key").startswith("pages/src1/")).orderBy("key")


@query("redrive_markers", "SELECT key FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'redrive/' || source || '/' || doc_id || '/marker' ELSE 'redrive/' || source || '/' || doc_id END AS key FROM documents) WHERE len(string_split(key, '/')) = 4 ORDER BY key")
def redrive_markers(spark: SparkSession, d: str) -> DataFrame:
    tail = F.when(F.col("doc_id") % 3 == 0, "/marker").otherwise("")
    key = F.concat(F.concat_ws("/", F.lit("redrive"), "source", F.col("doc_id").cast("string")), tail)
    return load(spark, d, "documents").select(key.alias("key")).where(F.size(F.split("key", "/")) == 4).orderBy("key")


@query("label_recall", "WITH f AS (SELECT doc_id, lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g')) AS folded, source FROM documents), l AS (SELECT source, lower(regexp_replace(arg_min(string_split(text, ' ')[1], doc_id), '[^A-Za-z0-9]+', '', 'g')) AS label FROM documents GROUP BY 1) SELECT f.source, count(*) AS nodes, count(*) FILTER (contains(folded, label)) AS found FROM f JOIN l USING (source) GROUP BY 1")
def label_recall(spark: SparkSession, d: str) -> DataFrame:
    """How many nodes hold their group's label, letters and digits only."""
    docs = load(spark, d, "documents")

    def fold(c):
        return F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", ""))

    labels = docs.groupBy("source").agg(F.min_by(F.get(F.split("text", " "), F.lit(0)), "doc_id").alias("w")).select("source", fold(F.col("w")).alias("label"))
    return docs.select("source", fold(F.col("text")).alias("folded")).join(labels, "source").groupBy("source").agg(F.count("*").alias("nodes"), F.count_if(F.contains("folded", "label")).alias("found"))


#: Bytes of passages, and 16 a word, that are broadcast at once.
BLOCK_BYTES = 16 << 20


@query("substring_audit", "SELECT b.item_id FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))")
def substring_audit(spark: SparkSession, d: str) -> DataFrame:
    """Passages that no document holds as a whole.

    A theta anti-join would compare all pairs. A passage is held where its inner words are whole words of a document,
    its first ends the word before them and its last starts the word after; so passages and documents meet on each
    passage's longest inner word, and the others are compared from there. Passages without an inner word are searched
    for as they are. Passages are broadcast in blocks of BLOCK_BYTES, and documents read once a block; no text moves.
    """
    b, docs = load(spark, d, "benchmark"), load(spark, d, "documents").select(F.col("text").alias("doc"))
    n, inner = F.size("words"), F.slice("words", 2, F.greatest(F.lit(0), F.size("words") - 2))
    passages = b.where("text is not null").select("text").distinct().select("text", F.split("text", " ").alias("words"))
    size = passages.agg(F.sum(F.octet_length("text") + 16 * n), F.count_if(n < 3)).first()
    blocks = max(1, math.ceil((size[0] or 0) / BLOCK_BYTES))

    longest = F.array_max(F.transform(inner, lambda v, i: F.struct(F.length(v).alias("len"), (-i).alias("i"), v.alias("key"))))
    keyed = passages.where(n >= 3).select("text", "words", longest.alias("k"))
    keyed = keyed.select("text", "words", F.col("k.key").alias("key"), (1 - F.col("k.i")).alias("at"))
    at = docs.select(F.split("doc", " ").alias("w")).select("w", F.posexplode_outer("w").alias("pos", "key"))
    first = F.greatest(F.lit(0), F.col("pos") - F.col("at"))  # of the words that the passage would lie in
    near = [F.get("w", F.col("pos") + k).eqNullSafe(F.get("words", F.col("at") + k)) for k in (-1, 1)]
    near = (near[0] | (F.col("at") == 1)) & (near[1] | (F.col("at") == n - 2))
    ends = F.endswith(F.get("w", first), F.get("words", F.lit(0))) & F.startswith(F.get("w", first + n - 1), F.get("words", n - 1))
    held = near & (F.col("pos") >= F.col("at")) & ends & (F.slice("w", first + 2, F.size(inner)) == inner)

    hit = passages.select("text").limit(0)
    for k in range(blocks):
        here = F.pmod(F.xxhash64("text"), F.lit(blocks)) == k
        hit = hit.union(at.join(F.broadcast(keyed.where(here)), "key").where(held).select("text"))
        if size[1]:
            hit = hit.union(docs.join(F.broadcast(passages.where((n < 3) & here)), F.contains("doc", "text")).select("text"))
    return b.join(hit.distinct(), "text", "left_anti").select("item_id")
