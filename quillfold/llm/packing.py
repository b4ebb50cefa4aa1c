"""Mixture-controlled packing of tokenised documents into fixed windows.

Every source is a queue of tokens. Deficit round-robin deals each window's places to the queues in the target
proportions and carries what a queue is still owed into the next window. Here the deficits live at the nodes of a
binary tree over the sources: of the first C tokens dealt to a node, floor(C * left / all) go to its left half and
the rest to its right half. The remainder of that division is the node's deficit; both shares only ever grow with C,
a window is always full, and each source stays within one token a level of its target. As the deficit follows from
C alone, any partition can start dealing anywhere: it needs its documents' places in their queues, which are sums
of counts over the partitions before it, and nothing else.

With weights, queues run dry at different times; the dealing is then done in phases, each with the sources that are
left. Without weights every queue is dealt in proportion to its length, so all run dry together, in one phase.

Documents are cut freely at window ends. Windows are full but for the last few: the last tokens that do not fill one
go to windows whose lengths are powers of two, so that none needs padding.

Cases: null or empty text is its end token alone; an added token's string in a text is that token; a null source is a
queue of its own; a null doc_id is carried along; repeated rows are packed each; long texts are cut at safe places for
the tokenizer's cache only; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import array
import json
import os
import re
import zlib
from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillfold.llm.common import frugal, stored, text_of

#: Rows of (block, source) offsets up to which they are broadcast (some 40 bytes each); beyond, they are joined.
BROADCAST_ROWS = 200_000
MAX_SOURCES = 100_000
#: Cached pieces of texts that are not merged by rank, of CACHE_CHARS at most: some 10 MB.
CACHE_PIECES = 40_000
CACHE_CHARS = 48
BATCH_CHARS = 400_000
#: Fixed by the vocabulary file's kind: how byte-level BPE splits a text before it merges.
PRE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_TOKENIZERS: dict[str, PieceTokenizer] = {}
_CUT = re.compile(r"(?<=\S) (?=\S)")
_STABLE = re.compile(r"[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*+")
_TWO_SPACES = re.compile(r"\s\s")


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceTokenizer:
    """Ids of whole texts by a byte-level BPE file.

    Texts of characters whose classes no Unicode version changes (ASCII and Latin letters) are merged by rank with the
    file's own vocabulary, whose ids stand in merge order. In other texts the
    file's tokenizer gives the ids of the pieces between single spaces, which are cached: byte-level BPE splits a text
    at every space between two other characters before it merges, and the space goes with what follows; so the ids of
    " piece" do not depend on the rest. Texts that hold one of the file's added tokens go to its tokenizer whole, which
    gives such a token its own id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.inner: dict[str, bytes] = {}
        self.fast = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, symbol = spec["model"]["vocab"], _byte_of_symbol()
        self.added = [x["content"] for x in spec.get("added_tokens", ())]
        ranks = {bytes(symbol[c] for c in t): i for t, i in vocabulary.items() if t not in self.added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [vocabulary[a + b] for a, b in merges]
        if order == sorted(order) and len(ranks) == 256 + len(merges):
            self.fast = tiktoken.Encoding("own", pat_str=PRE_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, pieces: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for e in self.tok.encode_batch(pieces, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        slow = []
        for i, t in enumerate(texts):
            if any(a in t for a in self.added):
                out[i] = self._encode([t])[0]
            elif self.fast is not None and _STABLE.fullmatch(t):
                out[i] = array.array("I", self.fast.encode_ordinary(t)).tobytes()
            else:
                slow.append(i)
        for i, b in zip(slow, self._by_piece([texts[i] for i in slow]), strict=True):
            out[i] = b
        return out

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        split = [_CUT.split(t) if _TWO_SPACES.search(t) else t.split(" ") for t in texts]
        heads = self._encode([p[0] for p in split])
        need: set[str] = set()
        for p in split:
            need.update(p[1:])
        new = [p for p in need if p not in self.inner]
        if len(new) + len(self.inner) > CACHE_PIECES:
            self.inner.clear()
            new = list(need)
        plain = [p for p in new if self.fast is not None and _STABLE.fullmatch(p)]
        other = [p for p in new if self.fast is None or not _STABLE.fullmatch(p)]
        self.inner.update((p, array.array("I", self.fast.encode_ordinary(" " + p)).tobytes()) for p in plain)
        self.inner.update(zip(other, self._encode([" " + p for p in other]), strict=True))
        get = self.inner.__getitem__
        out = [h + b"".join(map(get, p[1:])) for h, p in zip(heads, split, strict=True)]
        for p in new:
            if len(p) > CACHE_CHARS:
                del self.inner[p]
        return out


def tokenizer(path: str | None) -> PieceTokenizer:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]


@frugal
def _tokenise(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int) -> Iterator[pa.RecordBatch]:
    tok, block = tokenizer(path), TaskContext.get().partitionId()
    end, seen = array.array("I", [end_id]).tobytes(), {}
    for batch in batches:
        ids, sources, texts = (batch.column(i).to_pylist() for i in range(3))
        at = 0
        while at < len(texts):
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to]) <= BATCH_CHARS):
                chars += len(texts[to])
                to += 1
            rows = []
            for doc, source, buf in zip(ids[at:to], sources[at:to], tok.encode(texts[at:to]), strict=True):
                buf += end
                n, start = len(buf) // 4, seen.get(source, 0)
                seen[source] = start + n
                wide = np.frombuffer(buf, "<u4")
                rows.append((block, source, doc, n, start, wide.astype("<u2").tobytes() if wide.max() < 65536 else buf))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "source", "doc_id", "n", "start", "ids"])
            at = to


class Plan:
    """Where the deficit round-robin puts each token of each source's queue."""

    def __init__(self, totals: list[int], weights: list[float] | None, window: int):
        s, total = len(totals), sum(totals)
        if weights is None:
            marks = [[0] * s, list(totals)]
        else:
            # virtual times at which queues run dry; by each, a source has dealt weight * time tokens of its own
            times = sorted({n / w for n, w in zip(totals, weights, strict=True) if n})
            marks = [[0] * s] + [[n if n <= w * t * (1 + 1e-12) else int(w * t) for n, w in zip(totals, weights, strict=True)] for t in times]
        self.kind = object if total > 2_000_000_000 else np.int64
        self.marks = np.array(marks, dtype=self.kind).reshape(len(marks), s)
        quota = self.marks[1:] - self.marks[:-1]
        self.cum = np.concatenate([np.zeros((len(quota), 1), dtype=self.kind), np.cumsum(quota, axis=1)], axis=1)
        self.phase = np.concatenate([np.zeros(1, dtype=self.kind), np.cumsum(quota.sum(axis=1))])
        self.window, self.sources = window, s
        self.full = total // window
        tail, left = [], total - self.full * window
        while left:
            tail.append(1 << (left.bit_length() - 1))
            left -= tail[-1]
        self.windows = self.full + len(tail)
        self.tail = np.concatenate([[0], np.cumsum(tail, dtype=np.int64)]) if tail else np.zeros(1, np.int64)

    def begin(self, w: np.ndarray) -> np.ndarray:
        """The number of tokens dealt before window w."""
        extra = np.clip(w - self.full, 0, len(self.tail) - 1)
        return (np.minimum(w, self.full).astype(self.kind)) * self.window + self.tail[extra.astype(np.int64)]

    def dealt(self, k: int, s: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the first c tokens of phase k: those of the sources before s, and those of s."""
        cum, c = self.cum[k], c.copy()
        lo, hi = np.zeros_like(s), np.full_like(s, self.sources)
        before = np.zeros(len(s), dtype=self.kind)
        while True:
            split = hi - lo > 1
            if not split.any():
                return before, c
            mid = np.where(split, (lo + hi) // 2, hi)
            both = cum[hi] - cum[lo]
            left = np.where(both > 0, c * (cum[mid] - cum[lo]) // np.where(both > 0, both, 1), 0)
            left = np.where(split, left, c)
            right = split & (s >= mid)
            before = before + np.where(right, left, 0)
            c = np.where(right, c - left, left)
            lo, hi = np.where(right, mid, lo), np.where(split & ~right, mid, hi)

    def _upto(self, k: int, w: np.ndarray) -> np.ndarray:
        return np.clip(self.begin(w) - self.phase[k], 0, self.phase[k + 1] - self.phase[k])

    def _window_of(self, k: int, s: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The window that gets token x of source s in phase k: the last with fewer than x + 1 dealt before it."""
        lo, hi = np.zeros(len(s), np.int64), np.full(len(s), self.windows - 1, np.int64)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.dealt(k, s, self._upto(k, mid))[1] <= x
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    def pieces(self, s: np.ndarray, p: np.ndarray, n: np.ndarray):
        """For tokens [p, p + n) of the queues s: row, start in the row, length, window and offset of each piece."""
        for k in range(len(self.cum)):
            lo, hi = np.maximum(p, self.marks[k][s]), np.minimum(p + n, self.marks[k + 1][s])
            rows = np.flatnonzero(hi > lo)
            if not len(rows):
                continue
            src, own = s[rows], self.marks[k][s[rows]]
            x0, x1 = lo[rows] - own, hi[rows] - own
            first, last = self._window_of(k, src, x0), self._window_of(k, src, x1 - 1)
            many = last - first + 1
            at = np.repeat(np.arange(len(rows)), many)
            w = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            c0, c1 = self._upto(k, w), self._upto(k, w + 1)
            (b0, a0), (b1, a1) = self.dealt(k, src[at], c0), self.dealt(k, src[at], c1)
            start, stop = np.maximum(x0[at], a0), np.minimum(x1[at], a1)
            offset = c0 + self.phase[k] - self.begin(w) + b1 - b0 + start - a0
            keep = stop > start
            yield tuple(np.asarray(v[keep], dtype=np.int64) for v in (rows[at], start + own[at] - p[rows[at]], stop - start, w, offset))


@frugal
def _deal(batches: Iterator[pa.RecordBatch], names: list[str | None], totals: list[int], weights: list[float] | None, window: int) -> Iterator[pa.RecordBatch]:
    plan, index = Plan(totals, weights, window), {s: i for i, s in enumerate(names)}
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        s = np.array([index[x] for x in col["source"].to_pylist()], dtype=np.int64)
        n = col["n"].to_numpy(zero_copy_only=False)
        p = (col["start"].to_numpy(zero_copy_only=False) + col["base"].to_numpy(zero_copy_only=False)).astype(plan.kind)
        buffers = [memoryview(np.frombuffer(b, "<u2").astype("<u4").tobytes() if len(b) == 2 * k else b) for b, k in zip(col["ids"].to_pylist(), n.tolist(), strict=True)]
        for row, start, length, w, offset in plan.pieces(s, p, n):
            crc = [zlib.crc32(buffers[r][4 * a : 4 * (a + k)]) for r, a, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            arrays = [col["doc_id"].take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(w), pa.array(offset), col["source"].take(pa.array(row))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])


def pack(docs: DataFrame, window: int = 1024, weights: Mapping[str | None, float] | None = None, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    weights: a source's share of each window while its queue lasts (missing: 1). None: each source's share of all
    tokens.
    """
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), text_of(docs).alias("text"))
    tokens = stored(
        read.mapInArrow(partial(_tokenise, path=tokenizer_path, end_id=end_id), "block int, source string, doc_id long, n long, start long, ids binary"),
        "tokens",
    )
    sums = tokens.groupBy("block", "source").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a source has one row of sums for each block
    base = stored(sums.select(F.col("block").alias("at_block"), F.col("source").alias("at_source"), "n", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")), "bases")
    found = base.groupBy("at_source").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: give them coarser names")
    totals = {r["at_source"]: r["n"] for r in found}
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    side = base.select("at_block", "at_source", "base")
    if base.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    placed = tokens.join(side, (F.col("block") == F.col("at_block")) & F.col("source").eqNullSafe(F.col("at_source"))).select("source", "doc_id", "n", "start", "base", "ids")
    given = None if weights is None else [float(weights.get(s, 1.0)) for s in names]
    deal = partial(_deal, names=names, totals=[totals[s] for s in names], weights=given, window=window)
    return placed.mapInArrow(deal, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string")
