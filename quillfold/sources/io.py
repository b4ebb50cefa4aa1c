"""Readers and writers: manifests, uploaded files, write-once stores, content-keyed reads, status and report sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillfold.functions.codecs import custody_key
from quillfold.functions.rules import SHA256, first_failure

MANIFEST = "batch_id string, items array<struct<document_id: string, source_version: string, title: string, files: array<struct<path: string, role: string, sha256: string, size: bigint, media_type: string>>>>"
#: Signatures by which a file's kind is told, as hex of its first bytes.
SIGNATURES = (("25504446", "application/pdf"), ("89504E47", "image/png"), ("FFD8FF", "image/jpeg"), ("47494638", "image/gif"), ("504B0304", "application/zip"))


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """JSON by a given schema: (rows that fit, rejects with their text). Types are never inferred."""
    raw = spark.read.text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    ddl = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = raw.select("value", F.from_json("value", ddl + ", _corrupt string", options).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return parsed.where(~bad).select("r.*").drop("_corrupt"), parsed.where(bad).select(F.col("value").alias("rejected"))


def manifest_files(manifest: DataFrame) -> DataFrame:
    """One row a declared file: batch, item number, document, and the file's fields."""
    items = manifest.select("batch_id", F.posexplode("items").alias("idx", "item"))
    return items.select("batch_id", "idx", "item.document_id", F.explode_outer("item.files").alias("f")).select("batch_id", "idx", "document_id", "f.*")


def media_type(content) -> F.Column:
    """By signature; a PDF's may stand anywhere in the first 1024 bytes."""
    head = F.hex(F.substring(content, 1, 1024))
    kind = F.when(F.contains(head, F.lit("255044462D")), "application/pdf")
    for magic, name in SIGNATURES[1:]:
        kind = kind.when(F.startswith(head, F.lit(magic)), name)
    return kind.otherwise("application/octet-stream")


def uploads(spark: SparkSession, path: str, declared: DataFrame) -> DataFrame:
    """Files as received against their declarations (path, sha256, size, media_type): the first that differs."""
    received = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    seen = received.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.sha2("content", 256).alias("got"), F.octet_length("content").cast("long").alias("n"), media_type(F.col("content")).alias("kind"))
    x = declared.join(seen, "path", "left")
    reason = first_failure(
        (F.col("got").isNull(), "MISSING"),
        (~F.col("sha256").rlike(SHA256), "BAD_DIGEST"),
        (F.col("n") != F.col("size"), "SIZE"),
        (F.col("got") != F.col("sha256"), "DIGEST"),
        (F.col("kind") != F.col("media_type"), "MEDIA_TYPE"),
    )
    return x.select("path", "got", F.col("n").alias("received"), F.col("kind").alias("detected"), reason.alias("error"))


def with_custody(files: DataFrame) -> DataFrame:
    return files.withColumn("custody_ref", custody_key(F.col("document_id"), F.col("batch_id"), F.col("idx").cast("string"), F.col("sha256")))


def put_once(spark: SparkSession, store: str, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Append rows whose key the store does not hold, the first by `order` of each key; returns what was created.

    Each put is a folder of the store, so it is there as a whole or not at all once its job has ended. One writer at a
    time: without a transaction log two jobs could both append a key.
    """
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    try:
        first = first.join(spark.read.schema(rows.schema).parquet(store).select(key), key, "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    put = f"{store}/put={uuid.uuid4().hex}"
    first.select(*rows.columns).write.parquet(put)
    return spark.read.schema(rows.schema).parquet(put)


def read_registered(store: DataFrame, wanted: DataFrame, key: str = "key") -> DataFrame:
    """Stored content for wanted (key, sha256); missing or differing bytes are named, not passed on."""
    x = wanted.join(store.select(key, "content"), key, "left")
    error = F.when(F.col("content").isNull(), "MISSING").when(F.sha2("content", 256) != F.col("sha256"), "DIGEST")
    return x.select(key, F.when(error.isNull(), F.col("content")).alias("content"), error.alias("error"))


def list_prefix(store: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    return store.where(F.col(key).startswith(prefix)).orderBy(key)


def seed(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Start inputs for a corpus: ids from content, so that seeding twice gives the same ids."""
    ok = manifest.join(files.where("error is null").select("path"), "path")
    return ok.select(F.concat(F.lit("req_"), F.substring(F.sha2(F.concat_ws("|", "document_id", "sha256"), 256), 1, 24)).alias("request_id"), "document_id", "path", "sha256")


def status_sink(post: Callable[[dict], int]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that posts each report; 2xx is delivered, 409 out of position, all else an error, never raised."""

    def send(rows: Iterable) -> None:
        for r in rows:
            try:
                post(r.asDict(recursive=True))
            except Exception:  # noqa: BLE001 - a lost report is reported by the reconciler, not by the stream's failure
                continue

    return lambda batch, _: batch.foreachPartition(send)


def as_log_lines(df: DataFrame, **correlation: str) -> DataFrame:
    """JSON lines with correlation ids merged in."""
    return df.select(F.to_json(F.struct(*df.columns, *[F.lit(v).alias(k) for k, v in correlation.items()])).alias("line"))


def markdown(df: DataFrame, limit: int = 1000) -> str:
    """A report table; for the few rows of a report."""
    rows = df.limit(limit).collect()
    head = [df.columns, ["---"] * len(df.columns)]
    body = [["" if v is None else json.dumps(v, default=str) if isinstance(v, (list, dict)) else str(v) for v in r] for r in rows]
    return "\n".join("| " + " | ".join(cells) + " |" for cells in head + body)
