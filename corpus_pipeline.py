"""A training-corpus pipeline: each stage takes what the one before kept, written as Parquet and read again.

1. language_id: documents that the language models reject go.
2. line_dedup: lines of recurring templates go from all documents but their first.
3. near_dedup: one document of each class of near copies stays. Copies are linked if the exact similarity of their
   five-word shingles is 0.8 or more; the query op8 keeps to its own contract.
4. mix_sources: documents are taken as often as the mix to target weights says.
5. packing: the documents' pieces of windows of 1024 tokens.

Stages 1 to 4 return the columns of documents. Null and empty texts, nulls in other columns, repeated rows and empty
tables are treated as the operators' own docstrings say: null texts are rejected by stage 1.

Each stage starts from small heaps (shrink_heaps): all stages run in the same executors, and a stage of little garbage,
or one whose Python workers need the memory, would else bear the heap that an earlier one has left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillfold.llm import langid, line_dedup, mixing, near_copies, packing
from quillfold.llm.common import delete, documents, scratch, shared_dir, shrink_heaps


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink_heaps(spark)
    rest = langid.fold(docs["doc_id"], 4)
    model = langid.fit(docs.where(rest != 2).select("text", "lang"))
    return langid.accepted(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink_heaps(spark)
    return line_dedup.strip(docs, **line_dedup.SHARED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink_heaps(spark)
    return near_copies.representatives(docs, span=5, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink_heaps(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink_heaps(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

#: SQL has neither the character models, the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each stage's rows written to the shared folder and read by the next.

    What a stage stored for itself goes when it has ended, and its rows when the next stage has.
    """
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/quillfold-pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        delete(spark, before)
        before = [path]
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
