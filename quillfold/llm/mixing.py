"""Mixing sources to target weights by hash-threshold histograms.

Each source's target is filled with whole copies of all its documents and, for the rest, with the documents
whose hash lies under a threshold. The threshold is found from histograms: sizes are summed by source and hash
bucket, the bucket in which the budget runs out is found, and only that bucket is summed again by its next hash
bits. Nothing is sorted by document; a source of any size is only ever a row of sums per bucket.

Cases: null text has size 0; a null source is a source of its own, last in order; a null doc_id is hashed like any
value; repeated rows share their hash and are taken together; sources without words have target 0; an empty table
gives an empty result; other columns are not read, or carried along whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfold.llm.common import fresh, n_words, stored, text_of

BITS = 10  # of the hash that each histogram splits by
LEVELS = 6
#: Sources are configuration: as many rows as this reach the driver at most.
MAX_SOURCES = 100_000


def targets(sizes: dict[str | None, int], weights: Sequence[float], share: float, most: float) -> dict[str | None, float]:
    """The words each source shall give: share times all words, by weight, none above most times its own size.

    Sources stand in code-point order, null last, and take the weights in turn. What a full source leaves is
    reshared among the others by weight until none is above its limit.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out = share * sum(sizes.values()), {}
    free = sorted((s for s in order if sizes[s] > 0), key=lambda s: most * sizes[s] / weight[s])
    mass = sum(weight[s] for s in free)
    for s in free:
        out[s] = max(0.0, min(most * sizes[s], left * weight[s] / mass))
        left, mass = left - out[s], mass - weight[s]
    return {s: out.get(s, 0.0) for s in order}


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return stored(
        docs.select(
            "doc_id",
            docs["source"].cast("string").alias("source"),
            n_words(text_of(docs)).alias("size"),
            F.xxhash64(F.lit(seed), docs["doc_id"], text_of(docs)).alias("h"),
        ),
        "mix",
    )


def _thresholds(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """plan_source, source_size, target, copies, bits, below: a row a source."""
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: give them coarser names")
    sizes = {r["source"]: r["n"] or 0 for r in totals}
    goal = targets(sizes, weights, share, most)
    state = {s: _Threshold(int(goal[s] // n) if n else 0, goal[s] % n if n else 0.0) for s, n in sizes.items()}
    for level in range(LEVELS):
        open_ = {s: t for s, t in state.items() if not t.done}
        if not open_:
            break
        used = BITS * level
        at = spark.createDataFrame([(s, t.prefix, float(t.rest)) for s, t in open_.items()], "bound_source string, prefix long, rest double")
        here = sized.join(F.broadcast(at), F.col("source").eqNullSafe(F.col("bound_source")))
        if used:
            here = here.where(F.shiftrightunsigned("h", 64 - used) == F.col("prefix"))
        bucket = F.shiftrightunsigned("h", 64 - used - BITS).bitwiseAND((1 << BITS) - 1)
        # at most 2^BITS rows a source from here on
        sums = here.groupBy("source", "rest", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
        run = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("bucket")))
        below = F.col("upto") - F.col("size")
        edge = run.where((F.col("upto") > F.col("rest")) & (below <= F.col("rest"))).select("source", "bucket", "docs", "size", below.alias("below"))
        found = {r["source"]: r for r in edge.collect()}
        for s, t in open_.items():
            t.step(found.get(s), last=level == LEVELS - 1)
    rows = [(s, sizes[s], float(goal[s]), t.copies, t.bits, t.below) for s, t in state.items()]
    return spark.createDataFrame(rows, "plan_source string, source_size long, target double, copies long, bits int, below long")


def _copies(h: Column, plan: Column) -> Column:
    """By a plan: the copies of every document, and one more if the hash's first `bits` bits are under `below`."""
    under = (plan["bits"] > 0) & (F.call_function("shiftrightunsigned", h, 64 - plan["bits"]) < plan["below"])
    return plan["copies"] + under.cast("long")


def _plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    return _thresholds(_sized(docs, seed), weights, share, most)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken (size times copies)."""
    sized = _sized(docs, seed)
    plan = _thresholds(sized, weights, share, most)
    out = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("copies", _copies(F.col("h"), F.struct("copies", "bits", "below")))
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


class _Threshold:
    """A source's copies of every document, and the hash prefix under which documents are taken once more."""

    def __init__(self, copies: int, rest: float):
        self.copies, self.rest = copies, rest
        self.prefix = self.below = self.bits = 0
        self.done = rest <= 0

    def step(self, edge, last: bool) -> None:
        if edge is None:  # no bucket exceeds the budget: every document of this prefix is taken
            self.prefix += 1
            self.below, self.done = self.prefix, True
            self.bits = self.bits or 0
            return
        self.prefix = (self.prefix << BITS) | edge["bucket"]
        self.bits += BITS
        self.rest -= edge["below"]
        self.below = self.prefix
        if last or edge["docs"] <= 1:
            if 2 * self.rest >= edge["size"]:
                self.below += 1
            self.done = True


def mixed(docs: DataFrame, **how) -> DataFrame:
    """docs with each row as often as the mix takes it; rows that it does not take go.

    The decision depends on doc_id, source and text alone, so a row's copies are recomputed from the thresholds where
    the row is read, and no text is moved. Columns of any name are carried along.
    """
    plan = _plan(docs, **how).select(F.col("plan_source"), F.struct("copies", "bits", "below").alias("plan"))
    joined = docs.join(F.broadcast(plan), docs["source"].cast("string").eqNullSafe(plan["plan_source"]))
    times = _copies(F.xxhash64(F.lit(how.get("seed", 42)), docs["doc_id"], text_of(docs)), plan["plan"])
    again = joined.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias(fresh(docs, "copy")))
    return again.select(*docs.columns)
