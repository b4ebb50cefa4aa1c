"""Classes of near copies by exact similarity of their shingle sets.

Two documents are linked if the Jaccard similarity of their sets of `span`-word shingles (64-bit hashes) is `least` or
more; classes are the connected components. Pairs meet by prefix filtering, which loses none: of the sets in one order
of all shingles, two that are similar enough share a shingle among the first n - ceil(least n) + 1 of each. The order is
by hash; shingles that then stand in very many prefixes, as those of a passage that a third of all documents hold, are
put behind all others, so that only sets made of little else still meet by them.

Prefix groups are cut down by a 256-bit sketch of the set with a radius so wide that it is passed by all that is
similar enough (a pair of similarity 0.8 fails it with a probability under 1e-9): first every member against its
group's first, natively, then, in groups that this has not made one, all against all by simhash.links' bit planes. The
components of what passes hold every true link. In each, sets are compared exactly, tile pair by tile pair.

Cases: null and empty texts have the empty set and are one class; fewer words than a shingle: the whole sequence is
the one shingle; rows with null or shared doc_ids are told apart by their texts; texts of any length are read whole;
an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import forget, frugal, shrink_heaps, stored, text_of
from quillfold.llm.simhash import SEED, components, dealt, grouped, links_of, majority, near, one_each, row_key

LIMBS = 4
#: A shingle in the prefixes of over HOT_LEAST sets, and of over a share of HOT_SHARE, comes last in all sets' order. So
#: there are at most a fifth of the mean set size / HOT_SHARE such shingles: some megabytes, at any number of sets.
HOT_LEAST = 1024
HOT_SHARE = 1e-4
#: Of the sketch's 256 bits. Sets of 4 and 5 shingles are the worst case of similarity 0.8: 48 bits, give or take 6.2.
RADIUS = 88
#: Rows of two longs that are broadcast at most (32 MB); beyond, sets are shuffled to the picked rows.
BROADCAST_ROWS = 2_000_000


def shingle_set(text: str | bytes, span: int = 5) -> np.ndarray:
    """The sorted hashes of the text's shingles."""
    import xxhash

    w = (text.encode() if isinstance(text, str) else text).lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(w[i : len(w) - span + 1 + i] for i in range(span)), strict=True)) if len(w) >= span else [b" ".join(w)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, max(1, len(w) - span + 1)))


def prefix_length(n: int, least: float) -> int:
    return n - math.ceil(least * n - 1e-9) + 1 if n else 0


@frugal
def _sets(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        ids, keys, names, limbs, sets = zip(*rows, strict=True)
        cols = [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(names, pa.int64()), pa.array(limbs, pa.list_(pa.int64())), pa.array(sets, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "fp", "limbs", "grams"])

    import xxhash

    for batch in batches:
        rows, size = [], 0
        for d, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            s = shingle_set(text, span)
            name = np.uint64(xxhash.xxh64_intdigest(s.tobytes(), seed=SEED)).view(np.int64)
            rows.append((d, key, name, majority(s, LIMBS).view(np.int64), s.tobytes()))
            size += len(s)
            if size > 500_000:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)


@frugal
def _firsts(batches: Iterator[pa.RecordBatch], hot: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    """fp, limbs and the first shingles, `hot` (sorted) behind all others, of rows (fp, limbs, grams)."""
    for batch in batches:
        first = []
        for g in batch.column(2).to_pylist():
            grams = np.frombuffer(g, np.uint64)
            own = grams[: prefix_length(len(grams), least)]
            if len(own) and len(hot) and (hot[np.minimum(np.searchsorted(hot, own), len(hot) - 1)] == own).any():
                last = hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams
                own = np.concatenate([grams[~last], grams[last]])[: len(own)]
            first.append(own.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first, pa.list_(pa.int64()))], names=["fp", "limbs", "first"])


def _nodes(sets: DataFrame, least: float, hot_least: int) -> DataFrame:
    """A stored table of the distinct sets: fp, limbs and first."""

    def with_firsts(hot: np.ndarray) -> DataFrame:
        made = sets.select("fp", "limbs", "grams").mapInArrow(partial(_firsts, hot=hot, least=least), "fp long, limbs array<long>, first array<long>")
        return stored(made.dropDuplicates(["fp"]), "nodes")

    nodes = with_firsts(np.zeros(0, np.uint64))
    many = max(hot_least, int(nodes.count() * HOT_SHARE))
    hot = stored(nodes.select(F.explode("first").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > many).select("key"), "hot")
    keys = np.sort(np.array([r["key"] for r in hot.collect()], np.int64).view(np.uint64))
    forget(hot)
    if not len(keys):
        return nodes
    forget(nodes)
    return with_firsts(keys)


def distance(a: Column, b: Column) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(LIMBS)])


def coarse(nodes: DataFrame) -> DataFrame:
    """node, label: components of sets (fp, limbs, first) that share a prefix shingle and have near sketches."""
    keyed = nodes.select("fp", F.explode("first").alias("key"))
    groups = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("fp").alias("centre")).where("size > 1")
    met = stored(keyed.join(groups, "key"), "met")
    pairs = met.where("fp <> centre").select("fp", "centre").distinct()
    sketch = nodes.select("fp", "limbs")
    both = pairs.join(sketch, "fp").join(sketch.select(F.col("fp").alias("centre"), F.col("limbs").alias("other")), "centre")
    star = stored(both.where(distance(F.col("limbs"), F.col("other")) <= RADIUS).select(F.col("fp").alias("a"), F.col("centre").alias("b")), "star")
    of_star = components(star)
    labels = of_star.select(F.col("node").alias("fp"), "label")
    # a pair has been compared; so have groups that are one already
    left = stored(met.where("size > 2").select("key", "fp").join(labels, "fp", "left").select("key", "fp", F.coalesce("label", "fp").alias("label")), "left")
    forget(met, of_star)
    open_ = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    keys = left.select("key", "fp").join(open_, "key").join(sketch, "fp").select("fp", "limbs", F.lit(0).alias("table"), "key")
    found = components(star.union(links_of(keys, RADIUS)))
    forget(star, left)
    return found


def _alike(groups: list[tuple[np.ndarray, ...]], least: float) -> tuple[list[int], list[int]]:
    """Links (fp, fp) that span the classes of each group (fp, limbs, sets as bytes)."""
    a, b = [], []
    for (fp, cells, sets), hit in zip(groups, near(np.concatenate([g[1] for g in groups]), np.array([len(g[0]) for g in groups]), RADIUS), strict=True):
        n = np.array([len(s) // 8 for s in sets])
        starts = np.cumsum(n) - n
        _, place = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        mark = np.zeros(place.max(initial=-1) + 1, bool)
        unseen = np.ones(len(fp), bool)
        for root in range(len(fp)):
            if not unseen[root]:
                continue
            unseen[root] = False
            front = [root]
            while front:
                i = front.pop()
                to = np.flatnonzero(np.unpackbits(hit[i].view(np.uint8), bitorder="little")[: len(fp)].astype(bool) & unseen)
                to = to[np.minimum(n[to], n[i]) >= least * np.maximum(n[to], n[i]) - 1e-9]
                if not len(to):
                    continue
                own = place[starts[i] : starts[i] + n[i]]
                mark[own] = True
                same = np.array([np.count_nonzero(mark[place[starts[j] : starts[j] + n[j]]]) for j in to.tolist()])
                mark[own] = False
                found = to[same >= least * (n[to] + n[i] - same) - 1e-9]
                unseen[found] = False
                front += found.tolist()
                a += fp[found].tolist()
                b += [int(fp[i])] * len(found)
    return a, b


@frugal
def _verified(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for groups in grouped(batches, sets=True):
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _alike(groups, least)], names=["a", "b"])


def labelled(docs: DataFrame, span: int = 5, least: float = 0.8, hot_least: int = HOT_LEAST) -> DataFrame:
    """One row per document: doc_id, row (row_key) and label, its class's name."""
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs), text_of(docs).cast("binary").alias("text"))
    made = read.mapInArrow(partial(_sets, span=span), "doc_id long, row long, fp long, limbs array<long>, grams binary")
    sets = stored(made, "sets")
    shrink_heaps(docs.sparkSession)
    prints = stored(sets.select("doc_id", "row", "fp"), "prints")
    nodes = _nodes(sets, least, hot_least)
    found = coarse(nodes)
    forget(nodes)
    shrink_heaps(docs.sparkSession)
    # one row of each set is picked before any set moves, so that copies do not meet in one task
    coarsely = found.select(F.col("node").alias("fp"), F.col("label").alias("key"))
    picked = stored(prints.groupBy("fp").agg(F.min("row").alias("row")).join(coarsely, "fp").select("row", "key"), "picked")
    side = F.broadcast(picked) if picked.count() <= BROADCAST_ROWS else picked
    members = sets.select("row", "fp", "limbs", "grams").join(side, "row").dropDuplicates(["fp"]).select("fp", "limbs", F.lit(0).alias("table"), "key", "grams")
    edges = stored(dealt(members, "grams").mapInArrow(partial(_verified, least=least), "a long, b long").distinct(), "alike")
    forget(sets, found, picked)
    labels = components(edges).select(F.col("node").alias("fp"), "label")
    forget(edges)
    return prints.join(labels, "fp", "left").select("doc_id", "row", F.coalesce("label", "fp").alias("label"))


def representatives(docs: DataFrame, span: int = 5, least: float = 0.8) -> DataFrame:
    """docs with one row of each class: that of its smallest doc_id."""
    return one_each(docs, labelled(docs, span, least))
