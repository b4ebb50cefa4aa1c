"""Session settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(name: str, master: str | None = None, **more: str) -> SparkSession:
    b = SparkSession.builder.appName(name).config(map={**SETTINGS, **more})
    return (b.master(master) if master else b).getOrCreate()
