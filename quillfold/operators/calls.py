"""Calls and records around them: retries, lock order, strict inputs, answers of a picture method, outcomes, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.registry import query
from quillfold.sources.tables import FEED_SQL, ITEMS_SQL, REQUESTS_SQL, feed, items, load, requests

ATTEMPTS = 4


def retry_wait(status: Column, attempt: Column, retry_after: Column, attempts: int = ATTEMPTS) -> Column:
    """Seconds until a call is repeated; null if it is not. status: null for a transport error."""
    again = F.when(status.isNull(), F.pow(F.lit(2), attempt).cast("long")).when(status.isin(429, 503), F.when(retry_after.rlike("^[0-9]+$"), retry_after.cast("long")).otherwise(F.lit(1).cast("long")))
    return F.when(attempt < attempts, again)


@query("client_retry", f"WITH a AS (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 429 WHEN 'view' THEN 503 WHEN 'signup' THEN 404 ELSE 200 END AS status, 1 + user_id % {ATTEMPTS} AS attempt, CASE WHEN user_id % 3 = 0 THEN CAST(user_id % 7 AS VARCHAR) WHEN user_id % 3 = 1 THEN 'soon' END AS retry_after FROM events) SELECT event_id, status, attempt, CASE WHEN attempt < {ATTEMPTS} THEN CASE WHEN status IS NULL THEN CAST(2 ** attempt AS BIGINT) WHEN status IN (429, 503) THEN CASE WHEN regexp_matches(coalesce(retry_after, ''), '^[0-9]+$') THEN CAST(retry_after AS BIGINT) ELSE 1 END END END AS wait_s FROM a")
def client_retry(spark: SparkSession, d: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    status = F.when(kind == "error", None).when(kind == "click", 429).when(kind == "view", 503).when(kind == "signup", 404).otherwise(200)
    after = F.when(user % 3 == 0, (user % 7).cast("string")).when(user % 3 == 1, "soon")
    a = load(spark, d, "events").select("event_id", status.alias("status"), (1 + user % ATTEMPTS).alias("attempt"), after.alias("after"))
    return a.select("event_id", "status", "attempt", retry_wait(F.col("status"), F.col("attempt"), F.coalesce("after", F.lit(""))).alias("wait_s"))


@query("lock_order", f"WITH {ITEMS_SQL} SELECT batch_id, idx, row_number() OVER (PARTITION BY batch_id ORDER BY document_id, idx) AS locked FROM items")
def lock_order(spark: SparkSession, d: str) -> DataFrame:
    """A batch's items in the order in which their documents are locked, each with its own index to answer by."""
    locked = F.row_number().over(Window.partitionBy("batch_id").orderBy("document_id", "idx"))
    return items(spark, d).select("batch_id", "idx", locked.cast("long").alias("locked"))


def _kind(variant: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(variant, path, "variant"))


def start_valid(text: Column) -> Column:
    """Whether a JSON start input has its strings, an integer sequence (true is none) and a known priority."""
    v = F.try_parse_json(text)
    ok = F.coalesce(_kind(v, "$.adoption_sequence") == "BIGINT", F.lit(False)) & F.coalesce(F.get_json_object(text, "$.priority").isin("normal", "low"), F.lit(False))
    for key in ("request_id", "priority", "trace_id"):
        ok = ok & F.coalesce(_kind(v, f"$.{key}") == "STRING", F.lit(False))
    return ok


@query("start_validation", f"""WITH {REQUESTS_SQL}, j AS (SELECT request_id, concat('{{"request_id":', CASE WHEN request_id % 7 = 0 THEN CAST(request_id AS VARCHAR) ELSE '"r' || request_id || '"' END, ',"priority":"', CASE WHEN request_id % 11 = 0 THEN 'high' ELSE priority END, '","adoption_sequence":', CASE request_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN '"7"' WHEN 2 THEN '7.5' ELSE '7' END, CASE WHEN request_id % 13 = 0 THEN '}}' ELSE ',"trace_id":"t"}}' END) AS t FROM requests)
    SELECT request_id, coalesce(json_type(t, '$.request_id') = 'VARCHAR' AND json_type(t, '$.trace_id') = 'VARCHAR' AND json_type(t, '$.adoption_sequence') = 'UBIGINT' AND json_extract_string(t, '$.priority') IN ('normal', 'low'), false) AS valid FROM j""")
def start_validation(spark: SparkSession, d: str) -> DataFrame:
    r, k = requests(spark, d), F.col("request_id")
    sequence = F.when(k % 5 == 0, "true").when(k % 5 == 1, '"7"').when(k % 5 == 2, "7.5").otherwise("7")
    parts = [F.lit('{"request_id":'), F.when(k % 7 == 0, k.cast("string")).otherwise(F.concat(F.lit('"r'), k.cast("string"), F.lit('"'))), F.lit(',"priority":"'), F.when(k % 11 == 0, "high").otherwise(F.col("priority")), F.lit('","adoption_sequence":'), sequence, F.when(k % 13 == 0, "}").otherwise(',"trace_id":"t"}')]
    return r.select("request_id", start_valid(F.concat(*parts)).alias("valid"))


# The fields of a picture's interpretation, the last a list of marks; what they may be.
PICTURE_FIELDS = ("caption", "description", "figure_type", "chart_values")
FIGURE_TYPES = ("chart", "diagram", "photo", "screenshot", "table", "other")
MARK_KEYS = ("series", "category", "x", "value", "value_status")
VALUE_STATUS = ("printed", "estimated", "unreadable")
# end of fixed values


def picture_outcome(text: Column) -> tuple[Column, dict[str, Column]]:
    """The reason why an answer is invalid (null: valid), and each field's own outcome.

    Of marks, the keys and the status are checked.
    """
    v = F.try_parse_json(text)
    strict = F.coalesce(F.schema_of_variant(v).rlike("^OBJECT<"), F.lit(False)) & F.coalesce(F.size(F.json_object_keys(text)) == len(PICTURE_FIELDS), F.lit(False))
    value = {name: F.get_json_object(text, f"$.{name}") for name in PICTURE_FIELDS}
    for name in PICTURE_FIELDS[:3]:
        strict = strict & F.coalesce(_kind(v, f"$.{name}") == "STRING", F.lit(False))
    marks = F.from_json(value["chart_values"], "array<map<string, string>>")
    right = F.forall(marks, lambda m: F.coalesce((F.array_sort(F.map_keys(m)) == F.array(*[F.lit(k) for k in sorted(MARK_KEYS)])) & F.try_element_at(m, F.lit("value_status")).isin(*VALUE_STATUS), F.lit(False)))
    strict = strict & F.coalesce(_kind(v, "$.chart_values").startswith("ARRAY<"), F.lit(False)) & F.coalesce(right, F.lit(False)) & F.coalesce(value["figure_type"].isin(*FIGURE_TYPES), F.lit(False))
    blank = {name: F.trim(F.coalesce(value[name], F.lit(""))) == "" for name in PICTURE_FIELDS[:3]}
    nothing = blank["caption"] & blank["description"] & (value["chart_values"] == "[]")
    reason = F.when(F.trim(text) == "", "EMPTY_OUTPUT").when(~strict, "SCHEMA_INVALID").when(nothing, "EMPTY_OUTPUT")
    fields = {name: F.when(reason.isNull(), F.when(blank[name], "failed").otherwise("success") if name in blank else F.lit("success")) for name in PICTURE_FIELDS}
    return reason, fields


PICTURE_SQL = """p AS (SELECT conv_id, turn, CASE (conv_id * 7 + turn) % 8 WHEN 0 THEN ' ' WHEN 1 THEN 'no json' WHEN 2 THEN '{"caption":"","description":" ","figure_type":"chart","chart_values":[]}'
    WHEN 3 THEN '{"caption":"' || role || '","description":"","figure_type":"chart","chart_values":[]}' WHEN 4 THEN '{"caption":"a","description":"b","figure_type":"photo","chart_values":[],"more":1}'
    WHEN 5 THEN '{"caption":"a","description":"b","figure_type":"chart","chart_values":[{"series":null,"category":"c","x":1,"value":2,"value_status":"guessed"}]}' WHEN 6 THEN '{"caption":"a","description":"b","figure_type":"map","chart_values":[]}'
    ELSE '{"caption":"","description":"b","figure_type":"chart","chart_values":[{"series":null,"category":"c","x":1,"value":2,"value_status":"printed"}]}' END AS t FROM conversations)"""


@query("picture_fields", f"""WITH {PICTURE_SQL}, k AS (SELECT *, CASE (conv_id * 7 + turn) % 8 WHEN 0 THEN 'EMPTY_OUTPUT' WHEN 1 THEN 'SCHEMA_INVALID' WHEN 4 THEN 'SCHEMA_INVALID' WHEN 5 THEN 'SCHEMA_INVALID' WHEN 6 THEN 'SCHEMA_INVALID' WHEN 2 THEN 'EMPTY_OUTPUT' END AS reason FROM p)
    SELECT conv_id, turn, reason, CASE WHEN reason IS NULL THEN CASE WHEN trim(json_extract_string(t, '$.caption')) = '' THEN 'failed' ELSE 'success' END END AS caption, CASE WHEN reason IS NULL THEN CASE WHEN trim(json_extract_string(t, '$.description')) = '' THEN 'failed' ELSE 'success' END END AS description, CASE WHEN reason IS NULL THEN 'success' END AS figure_type, CASE WHEN reason IS NULL THEN 'success' END AS chart_values FROM k""")
def picture_fields(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a picture method held to their schema, with the fields that came out blank."""
    role = F.col("role")
    case = (F.col("conv_id") * 7 + F.col("turn")) % 8
    text = (
        F.when(case == 0, " ")
        .when(case == 1, "no json")
        .when(case == 2, '{"caption":"","description":" ","figure_type":"chart","chart_values":[]}')
        .when(case == 3, F.concat(F.lit('{"caption":"'), role, F.lit('","description":"","figure_type":"chart","chart_values":[]}')))
        .when(case == 4, '{"caption":"a","description":"b","figure_type":"photo","chart_values":[],"more":1}')
        .when(case == 5, '{"caption":"a","description":"b","figure_type":"chart","chart_values":[{"series":null,"category":"c","x":1,"value":2,"value_status":"guessed"}]}')
        .when(case == 6, '{"caption":"a","description":"b","figure_type":"map","chart_values":[]}')
        .otherwise('{"caption":"","description":"b","figure_type":"chart","chart_values":[{"series":null,"category":"c","x":1,"value":2,"value_status":"printed"}]}')
    )
    answers = load(spark, d, "conversations").select("conv_id", "turn", text.alias("answer"))
    reason, fields = picture_outcome(F.col("answer"))
    return answers.select("conv_id", "turn", reason.alias("reason"), *[c.alias(n) for n, c in fields.items()])


@query("outcome_records", f"WITH {ITEMS_SQL} SELECT batch_id, idx, 'enrichment-outcome/v1' AS schema, 'item' AS scope, CASE WHEN status = 'rejected' THEN 'failed' ELSE 'success' END AS outcome, CASE WHEN status = 'rejected' THEN 'SCHEMA_INVALID' END AS reason, CASE WHEN status = 'rejected' OR size % 2 = 0 THEN 'failed' ELSE 'success' END AS caption_outcome, CASE WHEN status = 'rejected' THEN 'SCHEMA_INVALID' WHEN size % 2 = 0 THEN 'EMPTY_OUTPUT' END AS caption_reason, path AS evidence FROM items")
def outcome_records(spark: SparkSession, d: str) -> DataFrame:
    """An item's outcome with its fields' own: a failed item fails every field for its reason."""
    failed, empty = F.col("status") == "rejected", F.col("size") % 2 == 0
    reason = F.when(failed, "SCHEMA_INVALID")
    return items(spark, d).select(
        "batch_id", "idx", F.lit("enrichment-outcome/v1").alias("schema"), F.lit("item").alias("scope"),
        F.when(failed, "failed").otherwise("success").alias("outcome"), reason.alias("reason"),
        F.when(failed | empty, "failed").otherwise("success").alias("caption_outcome"), F.when(failed, "SCHEMA_INVALID").when(empty, "EMPTY_OUTPUT").alias("caption_reason"), F.col("path").alias("evidence"),
    )


@query("failure_reports", f"WITH {FEED_SQL} SELECT document_uid, 'pdf-processing-failure/v1' AS schema, min(position) AS first_position, arg_min(event_id, position) AS request_id, CASE WHEN arg_min(value, position) < 50 THEN 'platform' ELSE 'content' END AS cause, 'requests/' || arg_min(event_id, position) || '/failure.json' AS ref FROM feed WHERE kind = 'error' GROUP BY document_uid")
def failure_reports(spark: SparkSession, d: str) -> DataFrame:
    """The first failure of each document is its report; later ones find it written."""
    first = feed(spark, d).where("kind = 'error'").groupBy("document_uid").agg(F.min(F.struct("position", "event_id", "value")).alias("f"))
    return first.select("document_uid", F.lit("pdf-processing-failure/v1").alias("schema"), F.col("f.position").alias("first_position"), F.col("f.event_id").alias("request_id"), F.when(F.col("f.value") < 50, "platform").otherwise("content").alias("cause"), F.concat(F.lit("requests/"), F.col("f.event_id").cast("string"), F.lit("/failure.json")).alias("ref"))
