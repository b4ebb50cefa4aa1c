"""SimHash near-duplicate classes with bit-sliced comparison.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Distinct fingerprints within
a radius are linked, classes are the connected components. Fingerprints meet in buckets, by tables of some of their
bits. For 64 bits the tables are exact: two fingerprints that differ in at most `radius` bits agree on two of
radius + 2 blocks of bits, and each pair of blocks is a table. For wider fingerprints each KEY_BITS bits are a table;
a pair within the radius meets with the probability that 1 of these is untouched (README has measured recall).

In a bucket all fingerprints are compared, many buckets at once. They are stored as vertical bit planes, 64 of them a
word; a row's distances to a word of others are counted together by carry-save counters, started so that they
overflow just above the radius, and a row's word is abandoned once all its counters have. Buckets over TILE
fingerprints are cut into tiles and compared tile pair by tile pair. A comparison gives a spanning forest of the links
that it finds, never all pairs; components are then found by minimum labels over the stored links with label jumping.

Cases: null and empty texts have fingerprint 0 and are linked like any other; fewer words than a shingle: the whole
sequence is the one shingle; a null doc_id takes part, but is no class's id unless its class has no other; repeated
rows each give a row of the same class; a class of null or shared doc_ids has its own representative; texts of any length are read whole; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import forget, fresh, frugal, stored, text_of

SEED = 42
TILE = 4096
KEY_BITS = 12
#: Words of counters that are compared at once, about.
AT_ONCE = 100_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _limb(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th 64 hash bits made from the first."""
    if not k:
        return h
    x = h + np.uint64(0x9E3779B97F4A7C15 * k & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(h: np.ndarray, limbs: int) -> np.ndarray:
    """The bits that over half of the hashes have, as 64-bit limbs."""
    out = np.zeros(limbs, np.uint64)
    for k in range(limbs):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 65536):
            ones += np.unpackbits(_limb(h[at : at + 65536], k).view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprint(text: str | bytes, span: int = 3, limbs: int = 1) -> list[int]:
    """One text's fingerprint as unsigned 64-bit limbs."""
    import xxhash

    w = (text.encode() if isinstance(text, str) else text).lower().split()
    if not w:
        return [0] * limbs
    n = max(1, len(w) - span + 1)
    shingles = map(b" ".join, zip(*(w[i : i + n] for i in range(span)), strict=True)) if len(w) >= span else [b" ".join(w)]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n), limbs).tolist()


@frugal
def _fingerprints(batches: Iterator[pa.RecordBatch], span: int, limbs: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t, span, limbs) for t in batch.column(1).to_pylist()], np.uint64).reshape(-1, limbs)
        cells = pa.ListArray.from_arrays(np.arange(0, prints.size + 1, limbs, dtype=np.int32), prints.view(np.int64).ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), cells], names=["doc_id", "row", "limbs"])


def fingerprints(docs: DataFrame, span: int = 3, limbs: int = 1) -> DataFrame:
    """doc_id, row (row_key), limbs (the fingerprint's bits as signed longs) and fp, one long that names the fingerprint."""
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"), row_key(docs))
    made = read.mapInArrow(partial(_fingerprints, span=span, limbs=limbs), "doc_id long, row long, limbs array<long>")
    return made.select("doc_id", "row", "limbs", (F.get("limbs", F.lit(0)) if limbs == 1 else F.xxhash64("limbs")).alias("fp"))


def bucket_keys(cells: Column, limbs: int, radius: int) -> Column:
    """An array of the buckets (table, key) of a fingerprint."""
    if limbs > 1:
        cuts = [(k, a) for k in range(limbs) for a in range(0, 64 - KEY_BITS + 1, KEY_BITS)]
        keys = [F.shiftrightunsigned(F.get(cells, F.lit(k)), a).bitwiseAND((1 << KEY_BITS) - 1) for k, a in cuts]
    else:
        fp, blocks = F.get(cells, F.lit(0)), radius + 2
        edges = [64 * i // blocks for i in range(blocks + 1)]
        part = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
        keys = [F.shiftleft(part[i], edges[j + 1] - edges[j]).bitwiseOR(part[j]) for i, j in combinations(range(blocks), 2)]
    return F.array(*[F.struct(F.lit(k).alias("table"), key.alias("key")) for k, key in enumerate(keys)])


def near(prints: np.ndarray, sizes: np.ndarray, radius: int) -> list[np.ndarray]:
    """For each group of `sizes` rows of prints (rows, limbs): a bit matrix of which rows lie within radius of which."""
    words = -(-sizes // 64)
    base = np.cumsum(words) - words  # each group's first word
    first = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = base[group] * 64 + np.arange(len(prints)) - first[group]
    many = words[group]
    row = np.repeat(np.arange(len(prints)), many)
    word = np.repeat(base[group], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    real = np.zeros(words.sum() * 64, np.uint8)
    real[place] = 1
    over = ~np.packbits(real, bitorder="little").view("<u8")[word]
    counters = int(radius).bit_length()
    start = (1 << counters) - 1 - radius  # a counter overflows at radius + 1 differing bits
    count = [np.full(len(row), ALL if start >> c & 1 else np.uint64(0)) for c in range(counters)]
    out, alive = np.zeros(len(row), np.uint64), np.arange(len(row))
    padded = np.zeros(len(real), np.uint64)
    for limb in range(prints.shape[1]):
        padded[place] = prints[:, limb]
        for b in range(64):
            plane = np.packbits((padded >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little").view("<u8")
            own = np.uint64(0) - ((prints[:, limb] >> np.uint64(b)) & np.uint64(1))
            carry = plane[word] ^ own[row]
            for c in count:
                both = c & carry
                c ^= carry
                carry = both
            over |= carry
            if b % 16 == 15:
                on = over != ALL
                if on.mean() < 0.8:
                    alive, row, word, over, count = alive[on], row[on], word[on], over[on], [c[on] for c in count]
    out[alive] = ~over
    cut = np.cumsum(sizes * words)[:-1]
    return [x.reshape(n, w) for x, n, w in zip(np.split(out, cut), sizes.tolist(), words.tolist(), strict=True)]


def forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of a symmetric bit matrix: (row, root of its component)."""
    m = len(hit)
    unseen = np.packbits(np.pad(np.ones(m, np.uint8), (0, -m % 64)), bitorder="little").view("<u8").copy()
    links = []
    for root in range(m):
        if not int(unseen[root // 64]) >> (root % 64) & 1:
            continue
        unseen[root // 64] &= ~np.uint64(1 << (root % 64))
        front = np.array([root])
        while len(front):
            new = np.bitwise_or.reduce(hit[front], axis=0) & unseen
            unseen &= ~new
            front = np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little"))
            links += [(int(i), root) for i in front]
    return links


def grouped(batches: Iterator[pa.RecordBatch], sets: bool = False) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """Some groups at a time: (fp, limbs) and, if told, the column after them, of two rows or more.

    Rows come sorted by (table, key, ti, tj); a group may span batches, and has no fingerprint twice.
    """
    held: list[tuple[np.ndarray, ...]] = []
    last, ready, work = None, [], 0

    def close() -> None:
        nonlocal held, work
        if held:
            g = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
            if len(g[0]) > 1:
                ready.append(g)
                work += len(g[0]) * -(-len(g[0]) // 64)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        fp = batch.column(4).to_numpy(zero_copy_only=False)
        cells = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(len(fp), -1).view(np.uint64)
        more = [batch.column(6).to_numpy(zero_copy_only=False)] if sets else []
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(fp)]])
        for i, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            key = tuple(keys[i].tolist())
            if key != last:
                close()
                if work >= AT_ONCE:
                    yield ready
                    ready, work = [], 0
            last = key
            held.append((fp[i:z], cells[i:z], *(x[i:z] for x in more)))
    close()
    if ready:
        yield ready


@frugal
def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for groups in grouped(batches):
        a, b = [], []
        sizes = np.array([len(g[0]) for g in groups])
        for (fp, _), hit in zip(groups, near(np.concatenate([g[1] for g in groups]), sizes, radius), strict=True):
            if np.bitwise_count(hit).sum() > len(hit):  # more than each row itself
                found = np.array(forest(hit))
                a.append(fp[found[:, 0]])
                b.append(fp[found[:, 1]])
        cols = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (a, b)]
        yield pa.RecordBatch.from_arrays(cols, names=["a", "b"])


def dealt(keyed: DataFrame, *more: str) -> DataFrame:
    """Rows (fp, limbs, table, key and more) of groups of two or more, dealt by group or tile pair and sorted."""
    sizes = keyed.groupBy("table", "key").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / F.lit(TILE // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles.cast("long")).cast("int")
    joined = keyed.join(sizes, ["table", "key"])
    small = F.array(F.struct(F.lit(0).alias("ti"), F.lit(0).alias("tj")))
    large = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(F.least(F.col("own"), k).alias("ti"), F.greatest(F.col("own"), k).alias("tj")))
    tiled = (
        joined.withColumn("tiles", tiles)
        .withColumn("own", own)
        .select("fp", "limbs", "table", "key", *more, F.explode(F.when(F.col("size") <= TILE, small).otherwise(large)).alias("t"))
        .select("table", "key", F.col("t.ti").alias("ti"), F.col("t.tj").alias("tj"), "fp", "limbs", *more)
    )
    return tiled.repartition("table", "key", "ti", "tj").sortWithinPartitions("table", "key", "ti", "tj")


def links_of(keyed: DataFrame, radius: int) -> DataFrame:
    """a, b: links within the groups (table, key) that span every component of those found linked."""
    return dealt(keyed).mapInArrow(partial(_links, radius=radius), "a long, b long").distinct()


def links(prints: DataFrame, limbs: int = 1, radius: int = 3) -> DataFrame:
    """a, b: links between distinct fingerprints (fp, limbs) that span every component of those found linked."""
    keyed = prints.select("fp", "limbs", F.explode(bucket_keys(F.col("limbs"), limbs, radius)).alias("k")).select("fp", "limbs", "k.table", "k.key")
    return links_of(keyed, radius)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """A stored table of node and label, the smallest node of its component, for every node of the edges (a, b).

    Each round takes the smallest label among a node and its neighbours and then that label's own label, so that
    paths halve. Only the number of changed labels reaches the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"), F.lit(True).alias("changed")), "labels")
    for _ in range(rounds):
        if not labels.where("changed").limit(1).count():
            forget(both)
            return labels
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").groupBy(F.col("a").alias("node")).agg(F.min("lb").alias("m"))
        low = labels.select("node", F.col("label").alias("old")).join(seen, "node").select("node", "old", F.least("old", "m").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        before, labels = labels, stored(low.join(jump, "low").select("node", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("old")).alias("changed")), "labels")
        forget(before)
    raise RuntimeError("components did not settle")


def row_key(docs: DataFrame) -> Column:
    """row: a hash of the doc_id, null or not, and the text."""
    own = docs["doc_id"].cast("long")
    return F.xxhash64(own.isNull(), own, docs["text"].isNull(), docs["text"]).alias("row")


def one_each(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """docs with one row of each label of labelled (doc_id, row, label): that of its smallest doc_id, nulls last."""
    rows, own = stored(labelled, "labelled"), fresh(docs, "own_row")
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
    kept = stored(first.select(F.col("least.row").alias(own)), "kept")
    left = docs.select("*", row_key(docs).alias(own)).join(kept, own, "left_semi")
    again = rows.join(kept, rows["row"] == kept[own], "left_semi").groupBy("row").agg(F.count("*").alias("n")).where("n > 1")
    return (left.dropDuplicates([own]) if again.limit(1).count() else left).select(*docs.columns)


def labelled(docs: DataFrame, span: int = 3, limbs: int = 1, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, row (row_key), limbs, label (its class's name) and component_id."""
    prints = stored(fingerprints(docs, span, limbs), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.max("limbs").alias("limbs")) if limbs > 1 else prints.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("limbs", F.array("fp")), "nodes")
    labels = components(links(nodes.select("fp", "limbs"), limbs, radius)).select(F.col("node").alias("fp"), "label")
    named = nodes.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    ids = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = named.join(ids, "label").select("fp", "label", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "row", "limbs", "label", "component_id")


def classes(docs: DataFrame, span: int = 3, limbs: int = 1, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits a limb), component_id (its class's smallest doc_id)."""
    digits = F.array_join(F.transform("limbs", lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")
    return labelled(docs, span, limbs, radius).select("doc_id", digits.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, **how) -> DataFrame:
    """docs with one row of each class: that of its smallest doc_id."""
    return one_each(docs, labelled(docs, **how))
