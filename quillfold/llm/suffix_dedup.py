"""Removal of long byte strings that occur earlier in the corpus, by prefix doubling over sampled suffixes.

Suffixes (positions) are ranked by prefixes of doubling length. The rank of a prefix of length 2m is the pair of the
ranks of its halves, named by a 64-bit hash of the pair, so ranks of 1, 2, 4 .. GRAM bytes need no sort at all and are
made where the text is read. From GRAM bytes on, Spark sorts (rank, rank at the next offset) pairs and only what is
not unique goes on, until the offset passes the threshold of `length` bytes:

1. Sampling. Every string of `length` bytes has an anchor: the position of the smallest GRAM-byte rank among its
   prefix positions. Equal strings have anchors at equal places, so only anchors need sorting: one position in some
   35. Round one sorts anchors by (rank of GRAM bytes, rank of the whole surroundings). Anchors whose GRAM bytes
   are unique are done. Of anchors with the same surroundings all but the first are repeats, with every string around
   them. The first of each surroundings goes on if its GRAM bytes have other surroundings too.
2. Every string through an anchor holds the anchor's GRAM bytes with the half surroundings on their left or on their
   right. Both halves are ranked and sorted as in round one: unique ones are done, repeats of all that a half's strings
   hold together are repeats.
3. For the strings at the other halves, ranks of `length` bytes are sorted; all but the first of a rank are repeats.

Within a block of text, repeats of an earlier row of the block are marked at once, so that a passage shared by any
share of all documents reaches a round's sort as one row a block.

Full dense reranking of every byte at each doubling would move some hundred bytes per byte of text; README has the
figures.

Cases: null text is empty; bytes are UTF-8; a null doc_id comes before all others; rows of one doc_id but different
texts are ordered by the hash of their texts; equal rows: the first keeps what one row alone would, the others are
repeats of it; texts of any length are cut into overlapping segments, never dropped; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import frugal, stored, text_of

GRAM = 32
PLACE_BITS = 20  # of a position within a buffer
BUFFER = 1 << 19
SEGMENT = 1 << 18
HELD = 300_000  # rows of a block
FIRST = -(1 << 63)
ANCHOR, MARKER, ASK, COVERED = 0, 1, 2, 3
MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of each pair of ranks."""
    t = b >> np.uint64(29)
    t ^= b
    t *= MULT[1]
    t += a * MULT[0]
    t ^= t >> np.uint64(32)
    return t


def gram_ranks(data: np.ndarray) -> np.ndarray:
    """The ranks of the GRAM bytes at each position, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MULT[2]
    h ^= h >> np.uint64(31)
    m = 1
    while m < GRAM:
        h = _pair(h[:-m], h[m:])
        m *= 2
    return h


def _spread(h: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """One rank from the gram ranks at several places."""
    out = np.full(len(places[0]), MULT[3])
    for p in places:
        out = _pair(out, h[p])
    return out


class Buffer:
    """Several texts' segments laid end to end, with the anchors of all strings of `length` bytes in them."""

    def __init__(self, segments: list[tuple[int, int, int, int, bytes]], length: int):
        """segments: text's number, text's size, first and last+1 start to be treated, bytes from max(0, first - reach)."""
        self.length, self.reach = length, length - GRAM
        data = np.frombuffer(b"".join(s[4] for s in segments), np.uint8)
        sizes = np.array([len(s[4]) for s in segments])
        at = np.cumsum(sizes) - sizes
        self.h = gram_ranks(data)
        place = np.uint64((1 << PLACE_BITS) - 1)
        key = (self.h & ~place) | np.arange(len(self.h), dtype=np.uint64)
        wide, low = self.reach + 1, key
        m = 1
        while 2 * m <= wide:
            low = np.minimum(low[:-m], low[m:])
            m *= 2
        if m < wide:
            low = np.minimum(low[: len(low) - (wide - m)], low[wide - m :])
        anchor = (low & place).astype(np.int64)
        # starts to be treated, in the buffer
        begin = np.array([max(0, s[2] - self.reach) for s in segments])
        first = at + np.array([s[2] for s in segments]) - begin
        count = np.array([s[3] - s[2] for s in segments])
        starts = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner = np.repeat(np.arange(len(segments)), count)
        anchor = anchor[starts]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])) if len(starts) else np.zeros(0, np.int64)
        self.run_first = starts[new]  # the first start that each anchor serves
        self.run_size = np.diff(np.append(new, len(starts)))
        self.anchor = anchor[new]
        seg = owner[new]
        self.shift = (begin - at)[seg]  # buffer position + shift = position in the text
        self.text = np.array([s[0] for s in segments])[seg]
        self.size = np.array([s[1] for s in segments])[seg]

    def position(self) -> np.ndarray:
        return self.anchor + self.shift

    def span(self, before: int, after: int) -> np.ndarray:
        """The rank of the bytes from `before` before each anchor to `after` after it, with how far the text's ends cut it."""
        pos = self.position()
        left, right = np.minimum(before, pos), np.minimum(after, self.size - pos)
        lo, hi = self.anchor - left, self.anchor + right - GRAM
        out = _spread(self.h, [np.clip(self.anchor + o, lo, hi) for o in (*range(-before, after - GRAM, GRAM), after - GRAM)])
        return _pair(out, (left * 1000 + right).astype(np.uint64))

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the chosen anchors' starts: anchor's index, position in the text, and two ranks of their `length` bytes."""
        size = self.run_size[chosen]
        which = np.repeat(chosen, size)
        start = np.repeat(self.run_first[chosen], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        steps = [*range(0, self.length - GRAM, GRAM), self.length - GRAM]
        return which, start + self.shift[which], _spread(self.h, [start + o for o in steps]), _spread(self.h, [start + o for o in reversed(steps)])


def _buffers(texts: Iterator[bytes], length: int) -> Iterator[Buffer]:
    held, size = [], 0
    for number, data in enumerate(texts):
        last = len(data) - length + 1
        for c in range(0, max(0, last), SEGMENT):
            stop = min(c + SEGMENT, last)
            part = data[max(0, c - length + GRAM) : min(len(data), stop + 2 * length)]
            if size + len(part) > BUFFER and held:
                yield Buffer(held, length)
                held, size = [], 0
            held.append((number, len(data), c, stop, part))
            size += len(part)
    if held:
        yield Buffer(held, length)


class Block:
    """Rows of a block of text until it is full: (key, second, doc, th, pos)."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])

    def drain(self):
        """Sorted columns; which rows start a new pair; which repeat the row before at the same place."""
        cols = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        self.parts, self.n = [], 0
        order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
        key, second, doc, th, pos = (c[order] for c in cols)
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (second[1:] == second[:-1])
        equal = same.copy()
        equal[1:] &= (doc[1:] == doc[:-1]) & (th[1:] == th[:-1]) & (pos[1:] == pos[:-1])
        return (key, second, doc, th, pos), ~same, equal


def _merged(doc: np.ndarray, th: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, ...]:
    """Half-open intervals joined where they touch in one document."""
    if not len(doc):
        return doc, th, a, z
    order = np.lexsort((a, th, doc))
    doc, th, a, z = doc[order], th[order], a[order], z[order]
    other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])])
    group = np.cumsum(other)
    span = int(z.max()) + 1 if len(z) else 1
    reach = np.maximum.accumulate(z + group * span) - group * span  # furthest end so far in the group
    new = other.copy()
    new[1:] |= a[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return doc[first], th[first], a[first], np.maximum.reduceat(z, first)


ROW = "key long, second long, doc long, th long, pos long, kind int"
NAMES = ["key", "second", "doc", "th", "pos", "kind"]


def _rows(key, second, doc, th, pos, kind: int) -> pa.RecordBatch:
    def signed(x):
        return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))

    return pa.RecordBatch.from_arrays([signed(c) for c in (key, second, doc, th, pos)] + [pa.array(np.full(len(doc), kind, np.int32))], names=NAMES)


def _scatter(doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Keys that spread rows which need no company over the partitions."""
    return _pair(doc.astype(np.int64).view(np.uint64), pos.astype(np.int64).view(np.uint64))


def _covered(doc, th, a, z) -> pa.RecordBatch:
    doc, th, a, z = _merged(doc, th, a, z)
    return _rows(_scatter(doc, a), z, doc, th, a, COVERED)


def _around(pos: np.ndarray, length: int, halved: bool) -> tuple[np.ndarray, np.ndarray]:
    """The interval of all strings through an anchor; halved: of those in its left or right half (see _halves)."""
    reach = length - GRAM
    if not halved:
        return np.maximum(0, pos - reach), pos + length
    p, right, half = pos // 2, pos % 2 == 1, reach // 2
    return np.maximum(0, p - np.where(right, half, reach)), p + length - np.where(right, 0, half)


def _kept(key, second, doc, th, pos) -> Iterator[pa.RecordBatch]:
    """Rows with a key of their own in the block go on; of others all are asked for, and a marker tells of them."""
    change = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    many = np.bincount(np.cumsum(change) - 1)[np.cumsum(change) - 1] > 1 if len(key) else change
    yield _rows(key[~many], second[~many], doc[~many], th[~many], pos[~many], ANCHOR)
    mark = many & change
    none = np.zeros(mark.sum())
    yield _rows(key[mark], np.full(mark.sum(), FIRST), np.full(mark.sum(), FIRST), none, none, MARKER)
    yield _rows(_scatter(doc[many], pos[many]), second[many], doc[many], th[many], pos[many], ASK)


@frugal
def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows of round one: anchors, markers, anchors to be asked for in round two, covered intervals (pos to second)."""
    block, reach = Block(), length - GRAM

    def out():
        cols, new, equal = block.drain()
        _, _, doc, th, pos = cols
        again = ~new & ~equal
        yield _covered(doc[again], th[again], *_around(pos[again], length, False))
        yield from _kept(*(c[new] for c in cols))

    for batch in batches:
        docs, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        for buffer in _buffers(iter(batch.column(2).to_pylist()), length):
            block.add(buffer.h[buffer.anchor], buffer.span(reach, length), docs[buffer.text], ths[buffer.text], buffer.position())
            if block.n >= HELD:
                yield from out()
    if block.n:
        yield from out()


@frugal
def _resolve(batches: Iterator[pa.RecordBatch], length: int, halved: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, second, doc, th, pos. Out: intervals covered and anchors to ask for (kind)."""
    last = None  # key, second, doc, th, pos of the last row
    seen, held = 0, None  # surroundings seen of the last key; the first of them if it is not settled

    for batch in batches:
        if not batch.num_rows:
            continue
        key, second, doc, th, pos, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        plain = kind >= ASK
        for k in (ASK, COVERED):
            on = kind == k
            if on.any():
                yield _rows(key[on], second[on], doc[on], th[on], pos[on], k)
        if plain.all():
            continue
        key, second, doc, th, pos, kind = (c[~plain] for c in (key, second, doc, th, pos, kind))
        before = [np.concatenate([[c[0] if last is None else v], c[:-1]]) for c, v in zip((key, second, doc, th, pos), last or (0,) * 5, strict=True)]
        new_key = key != before[0]
        new_key[0] |= last is None
        new = new_key | (second != before[1])
        equal = ~new & (doc == before[2]) & (th == before[3]) & (pos == before[4])
        again = ~new & ~equal
        yield _covered(doc[again], th[again], *_around(pos[again], length, halved))
        run = np.cumsum(new_key)  # 0: goes on from the last batch
        kinds = np.bincount(run, new * np.where(kind == MARKER, 2, 1), run[-1] + 1).astype(np.int64)
        kinds[0] += seen
        asked = new & (kinds[run] > 1) & (kind == ANCHOR)
        yield _rows(key[asked], second[asked], doc[asked], th[asked], pos[asked], ASK)
        if held is not None and kinds[0] > 1:
            yield _rows(*[np.array([v]) for v in held], ASK)
            held = None
        if run[-1]:
            held = None
        seen = int(kinds[-1])
        if seen == 1 and held is None:
            i = np.flatnonzero(new)
            i = i[run[i] == run[-1]]
            if len(i):
                held = tuple(c[i[0]] for c in (key, second, doc, th, pos))
        last = tuple(c[-1] for c in (key, second, doc, th, pos))


def _asked(batches: Iterator[pa.RecordBatch], length: int):
    """Buffers of texts (doc, th, text, asked) with the asked numbers, halved to positions, that are there for each anchor."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        docs, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        asked = [np.asarray(x, np.int64) for x in batch.column(3).to_pylist()]
        texts = (unpack.decompress(x) if x else b"" for x in batch.column(2).to_pylist())
        for buffer in _buffers(texts, length):
            pos = 2 * buffer.position()
            starts = np.flatnonzero(np.concatenate([[True], buffer.text[1:] != buffer.text[:-1]])) if len(pos) else np.zeros(0, np.int64)
            left, right = np.zeros(len(pos), bool), np.zeros(len(pos), bool)
            for i, z in zip(starts.tolist(), [*starts[1:].tolist(), len(pos)], strict=True):
                left[i:z] = np.isin(pos[i:z], asked[buffer.text[i]])
                right[i:z] = np.isin(pos[i:z] + 1, asked[buffer.text[i]])
            yield buffer, left, right, docs[buffer.text], ths[buffer.text]


@frugal
def _halves(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows of round two: both halves of each asked anchor; pos is twice the anchor's, and one more for the right half.

    key: the rank of the half's core, which all its strings hold; second: the rank of all that they hold together.
    """
    block, reach = Block(), length - GRAM
    half = reach // 2

    def out():
        cols, new, equal = block.drain()
        _, _, doc, th, pos = cols
        again = ~new & ~equal
        yield _covered(doc[again], th[again], *_around(pos[again], length, True))
        yield from _kept(*(c[new] for c in cols))

    for buffer, asked, _, doc, th in _asked(batches, length):
        pos = buffer.position()
        for side, fits, core, whole in ((0, pos >= half, (half, GRAM), (reach, length - half)), (1, pos + length - half <= buffer.size, (0, length - half), (half, length))):
            on = asked & fits
            key = _pair(buffer.span(*core), np.full(len(pos), side, np.uint64))
            block.add(key[on], buffer.span(*whole)[on], doc[on], th[on], 2 * pos[on] + side)
        if block.n >= HELD:
            yield from out()
    if block.n:
        yield from out()


@frugal
def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows of round three: the strings at the asked halves; repeats within a block are covered at once."""
    block, half = Block(), (length - GRAM) // 2

    def out():
        (a, b, doc, th, pos), new, equal = block.drain()
        again = ~new & ~equal
        yield _covered(doc[again], th[again], pos[again], pos[again] + length)
        yield _rows(a[new], b[new], doc[new], th[new], pos[new], ANCHOR)

    for buffer, left, right, doc, th in _asked(batches, length):
        which, start, one, two = buffer.strings(np.flatnonzero(left | right))
        before = buffer.position()[which] - start
        on = (left[which] & (before >= half)) | (right[which] & (before <= half))
        which, start = which[on], start[on]
        block.add(one[on], two[on], doc[which], th[which], start)
        if block.n >= HELD:
            yield from out()
    if block.n:
        yield from out()


@frugal
def _repeats(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of round two: all but the first of a rank are covered."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, second, doc, th, pos, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        on = kind == COVERED
        if on.any():
            yield _rows(key[on], second[on], doc[on], th[on], pos[on], COVERED)
        key, second, doc, th, pos = (c[~on] for c in (key, second, doc, th, pos))
        if not len(key):
            continue
        before = [np.concatenate([[c[0] if last is None else v], c[:-1]]) for c, v in zip((key, second, doc, th, pos), last or (0,) * 5, strict=True)]
        new = (key != before[0]) | (second != before[1])
        new[0] |= last is None
        again = ~new & ~((doc == before[2]) & (th == before[3]) & (pos == before[4]))
        yield _covered(doc[again], th[again], pos[again], pos[again] + length)
        last = tuple(c[-1] for c in (key, second, doc, th, pos))


@frugal
def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [pack.compress(t) if t else b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], names=batch.schema.names)


@frugal
def _finish(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, doc, th, text, ordinal, cuts) to results. cuts: array of (pos, end)."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        ids, packed, copies, cuts = (batch.column(batch.schema.names.index(c)) for c in ("doc_id", "text", "copy", "cuts"))
        out: list[list] = [[], [], [], [], []]
        for p, copy, cut in zip(packed.to_pylist(), copies.to_pylist(), cuts.to_pylist(), strict=True):
            data = unpack.decompress(p) if p else b""
            spans: list[list[int]] = []
            for a, z in [(0, len(data))] if copy == 1 else sorted((c["pos"], min(len(data), c["second"])) for c in cut or ()):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(z, spans[-1][1])
                else:
                    spans.append([a, z])
            kept, at = [], 0
            for a, z in spans:
                kept.append(data[at:a])
                at = z
            kept.append(data[at:])
            left = b"".join(kept)
            row = (len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left if texts else None)
            for o, v in zip(out, row, strict=True):
                o.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        made = [pa.array(o, k) for o, k in zip(out, kinds, strict=True)][: 5 if texts else 4]
        yield pa.RecordBatch.from_arrays([ids, *made], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if texts else 5])


def dedup(docs: DataFrame, length: int = 100, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes, with texts)."""
    if length < 2 * GRAM:
        raise ValueError(f"length: {2 * GRAM} or more")
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(FIRST))
    ids = docs.select(doc.alias("doc"))
    unique = ids.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0
    # texts of one doc_id are told apart by their hashes; where there are none such, nothing needs to travel
    th = F.lit(0).cast("long") if unique else F.xxhash64(text_of(docs))
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), doc.alias("doc"), th.alias("th"), text_of(docs).cast("binary").alias("text"))
    order = ["key", "second", "doc", "th", "pos"]
    one = read.select("doc", "th", "text").mapInArrow(partial(_anchors, length=length), ROW)
    first = stored(one.repartition("key").sortWithinPartitions(*order).mapInArrow(partial(_resolve, length=length, halved=False), ROW), "anchors")
    packed = read.select("doc", "th", "text").mapInArrow(_zip, "doc long, th long, text binary")

    def with_asked(found: DataFrame, number) -> DataFrame:
        return packed.join(found.where(F.col("kind") == ASK).groupBy("doc", "th").agg(F.collect_set(number).alias("asked")), ["doc", "th"])

    two = with_asked(first, F.col("pos") * 2).mapInArrow(partial(_halves, length=length), ROW)
    second = stored(two.repartition("key").sortWithinPartitions(*order).mapInArrow(partial(_resolve, length=length, halved=True), ROW), "halves")
    three = with_asked(second, F.col("pos")).mapInArrow(partial(_strings, length=length), ROW)
    third = stored(three.repartition("key").sortWithinPartitions(*order).mapInArrow(partial(_repeats, length=length), ROW), "strings")
    cuts = first.union(second).where(F.col("kind") == COVERED).union(third).select("doc", "th", "pos", "second")
    by_doc = cuts.groupBy("doc", "th").agg(F.collect_list(F.struct("pos", "second")).alias("cuts"))
    full = read.mapInArrow(_zip, "doc_id long, doc long, th long, text binary")
    if unique:
        full = full.withColumn("copy", F.lit(0))
    else:
        # equal rows: the first is treated as the one document, the others are repeats of it where they are long enough
        from pyspark.sql import Window

        number = F.row_number().over(Window.partitionBy("doc", "th").orderBy(F.lit(0)))
        size = read.select("doc", "th", F.octet_length("text").alias("bytes")).distinct()
        full = full.withColumn("number", number).join(size, ["doc", "th"]).withColumn("copy", ((F.col("number") > 1) & (F.col("bytes") >= length)).cast("int"))
    joined = full.join(by_doc, ["doc", "th"], "left").select("doc_id", "text", F.col("copy").cast("int").alias("copy"), "cuts")
    return joined.mapInArrow(partial(_finish, texts=texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)
