"""Record folds as Structured Streaming operators, equal to their batch forms over the same log.

Each keeps a small state a key (never the key's history) and drops it by timeout. Rows of a key are taken in
(time, id) order within a micro-batch; across micro-batches arrival order is the order, as it is for the log itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REPLAY_HOURS = 24


def read_log(spark: SparkSession, path: str, schema, files_a_batch: int = 1, time: str = "ts") -> DataFrame:
    """An append-only Parquet log as a stream; its time column as TIMESTAMP, which watermarks need."""
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)
    return log.withColumn(time, F.col(time).cast("timestamp"))


def _ordered(parts: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(parts), ignore_index=True).sort_values(order, kind="stable")


def _replay(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    rows = _ordered(parts, ["ts", "event_id"])
    body, until = state.get if state.exists else (None, None)
    out = []
    for event, ts, new in zip(rows["event_id"], rows["ts"], rows["body"], strict=True):
        us = int(ts.value // 1000)
        if body is None or us >= until:
            body, until, verdict = new, us + REPLAY_HOURS * 3_600_000_000, "stored"
        else:
            verdict = "replayed" if new == body else "mismatch"
        out.append((event, key[0], verdict))
    state.update((body, until))
    state.setTimeoutTimestamp(max(until // 1000, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["event_id", "key", "verdict"])


def idempotent_replay(requests: DataFrame) -> DataFrame:
    """requests (key, ts, event_id, body): the first body of a key is stored for a day, then replayed or a mismatch."""
    marked = requests.withWatermark("ts", "1 hour")
    return marked.groupBy("key").applyInPandasWithState(_replay, "event_id long, key string, verdict string", "body string, until long", "append", GroupStateTimeout.EventTimeTimeout)


def _intake(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    top = state.get[0] if state.exists else None
    out = []
    for r in _ordered(parts, ["event_id"]).itertuples():
        if r.stage == "error":
            verdict = "bad_stage"
        elif top is not None and r.seq == top:
            verdict = "repeated"
        elif top is not None and r.seq < top:
            verdict = "out_of_order"
        else:
            verdict, top = "recorded", int(r.seq)
        out.append((int(r.event_id), verdict))
    if top is not None:
        state.update((top,))
    yield pd.DataFrame(out, columns=["event_id", "verdict"])


def report_intake(reports: DataFrame) -> DataFrame:
    """reports (attempt, event_id, stage, seq): each against the highest sequence that the attempt recorded before."""
    return reports.groupBy("attempt").applyInPandasWithState(_intake, "event_id long, verdict string", "top long", "append", GroupStateTimeout.NoTimeout)


def _bucket(capacity: float, a_second: float) -> Callable:
    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tokens, at = state.get if state.exists else (capacity, None)
        out = []
        for event, ts, n in _ordered(parts, ["ts", "n"])[["event_id", "ts", "n"]].itertuples(index=False):
            s = ts.value / 1e9
            tokens = min(capacity, tokens + (0.0 if at is None else (s - at) * a_second))
            at, ok = s, tokens >= n
            tokens -= n if ok else 0
            out.append((int(event), key[0], bool(ok), 0 if ok else max(1, -int(-(n - tokens) // a_second))))
        state.update((tokens, at))
        yield pd.DataFrame(out, columns=["event_id", "source", "granted", "wait_s"])

    return fold


def token_bucket(requests: DataFrame, capacity: float = 50.0, a_minute: float = 50.0) -> DataFrame:
    """requests (source, ts, event_id, n): granted, or the seconds to wait."""
    return requests.groupBy("source").applyInPandasWithState(_bucket(capacity, a_minute / 60), "event_id long, source long, granted boolean, wait_s long", "tokens double, at double", "append", GroupStateTimeout.NoTimeout)


def _facts(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    version, kept = state.get if state.exists else (None, None)
    for r in _ordered(parts, ["position"]).itertuples():
        if version is None or r.fact_version >= version:
            version, kept = int(r.fact_version), r.state
    state.update((version, kept))
    yield pd.DataFrame([(key[0], key[1], kept, version)], columns=["build", "document_uid", "state", "fact_version"])


def facts_current(facts: DataFrame) -> DataFrame:
    """facts (build, document_uid, state, fact_version, position): the highest version wins, an equal one applies again."""
    return facts.groupBy("build", "document_uid").applyInPandasWithState(_facts, "build long, document_uid string, state string, fact_version long", "fact_version long, state string", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(log: DataFrame, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Entries a kind and window; windows close when the watermark passes, later rows are dropped."""
    return log.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("entries")).select(F.col("window.start").alias("start"), "event_type", "entries")


def deduplicated(log: DataFrame, late: str = "2 hours") -> DataFrame:
    """Redelivered entries once each, remembered as long as the watermark allows."""
    return log.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def deliver(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append"):
    """Run what there is through a foreachBatch sink; a batch id may be repeated after a failure, so sinks key by it."""
    return stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
