"""Streaming folds give what the batch forms give, also over several micro-batches and a restart."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillfold import registry
from quillfold.sources.tables import feed, load
from quillfold.streaming import folds

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The events as a log of three files in id order."""
    path = str(tmp_path_factory.mktemp("log"))
    e = load(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    n = e.count()
    for k in range(3):
        e.where((F.col("event_id") >= n * k // 3) & (F.col("event_id") < n * (k + 1) // 3)).coalesce(1).write.mode("append").parquet(path)
    return path, e.schema


def run(spark, stream, tmp_path, mode="append"):
    rows = []
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        q = folds.deliver(stream, str(tmp_path / "checkpoint"), lambda df, _: rows.extend(df.collect()), mode)
        q.awaitTermination()
    return rows


def test_report_intake_equals_batch(spark, log, tmp_path):
    s = folds.read_log(spark, *log)
    reports = s.select(F.concat(F.lit("doc_"), F.col("user_id").cast("string")).alias("attempt"), "event_id", F.col("event_type").alias("stage"), F.round("value").cast("long").alias("seq"))
    got = Counter(map(tuple, run(spark, folds.report_intake(reports), tmp_path)))
    assert got == Counter(map(tuple, registry.queries()["report_intake"](spark, SF).collect()))


def test_facts_equal_batch(spark, log, tmp_path):
    s = folds.read_log(spark, *log)
    state = F.when(F.col("event_type") == "error", "removed").when(F.col("event_type") == "click", "pending").otherwise("included")
    f = s.select((F.col("user_id") % 20).alias("build"), F.concat(F.lit("doc_"), F.col("user_id").cast("string")).alias("document_uid"), state.alias("state"), F.round("value").cast("long").alias("fact_version"), F.col("event_id").alias("position"))
    last = {(r[0], r[1]): (r[2], r[3]) for r in run(spark, folds.facts_current(f), tmp_path, "update")}
    # the log is in id order, so the batch form must break ties by id too
    b = feed(spark, SF)
    st = F.when(F.col("kind") == "error", "removed").when(F.col("kind") == "click", "pending").otherwise("included")
    v = F.round("value").cast("long")
    want = b.groupBy("source_id", "document_uid").agg(F.max_by(st, F.struct(v, "event_id")).alias("s"), F.max(v).alias("v"))
    assert last == {(r[0], r[1]): (r[2], r[3]) for r in want.collect()}


def test_replay_within_a_day(spark, tmp_path):
    rows = [("k", "2024-01-01 00:00:00", 1, "a"), ("k", "2024-01-01 01:00:00", 2, "a"), ("k", "2024-01-01 02:00:00", 3, "b"), ("k", "2024-01-02 00:00:00", 4, "b"), ("j", "2024-01-01 00:00:00", 5, "b")]
    df = spark.createDataFrame(rows, "key string, ts string, event_id long, body string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = run(spark, folds.idempotent_replay(folds.read_log(spark, str(tmp_path / "in"), df.schema)), tmp_path)
    assert {r["event_id"]: r["verdict"] for r in got} == {1: "stored", 2: "replayed", 3: "mismatch", 4: "stored", 5: "stored"}


def test_token_bucket_stream(spark, tmp_path):
    rows = [(1, f"2024-01-01 00:00:0{s}", i, n) for i, (s, n) in enumerate([(0, 1.0), (0, 2.0), (0, 3.0), (5, 3.0)])]
    df = spark.createDataFrame(rows, "source long, ts string, event_id long, n double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = run(spark, folds.token_bucket(folds.read_log(spark, str(tmp_path / "in"), df.schema), 3.0, 60.0), tmp_path)
    assert {r["event_id"]: (r["granted"], r["wait_s"]) for r in got} == {0: (True, 0), 1: (True, 0), 2: (False, 3), 3: (True, 0)}


def test_windows_close_and_duplicates_go(spark, log, tmp_path):
    s = folds.read_log(spark, *log)
    closed = run(spark, folds.windowed_counts(s), tmp_path / "w")
    batch = {(r[0], r[1]): r[2] for r in load(spark, SF, "events").groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")), "event_type").agg(F.count("*")).collect()}
    assert closed and all(batch[(r["start"], r["event_type"])] >= r["entries"] for r in closed)
    twice = s.union(s)
    got = run(spark, folds.deduplicated(twice, "60 days").select("event_id"), tmp_path / "d")
    assert len(got) == len({r[0] for r in got}) == load(spark, SF, "events").count()
