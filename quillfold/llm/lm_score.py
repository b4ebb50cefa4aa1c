"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per document. The end and the most frequent words are classes of their own;
every other word, seen or not, belongs to one of `tails` classes by its first and last two bytes, so that each word is
told from others as a target and as a context. Two preceding classes predict the next: the score of class w is
(C1 * r[c1] + C2 * r[c2]) . q[w] + b[w], trained against noise from the unigram distribution, document block by
document block over all positions of all training documents, and averaged. The score is a sum of two tables, so all
normalisers Z[c1, c2] = sum_w exp(T1[c1, w]) exp(b[w]) exp(T2[c2, w]) are one matrix product, and every token's
probability is exactly normalised. A word of a tail class then has its smoothed share of that class's training tokens,
one unseen word included, so the whole is a distribution over all words.

Counts cover all training documents. The commonest words' counts, HEAD or some more, are looked up where the text is
read; the others' travel by word to the table of counts, so that no table that grows with the corpus is broadcast.
Blocks are the input's partitions: files that are split otherwise give another average.

Cases: null or empty text is its end token; a null doc_id is scored, neither held out nor learned from; repeated rows
each give a row; texts of any length are scored whole; without training documents all counts are 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import frugal, stored, text_of

HEAD = 65_536
FLUSH_WORDS = 150_000
END = 0
ALPHA = 0.1


@dataclass
class Settings:
    #: Classes at most: the end, words of their own class, and a half that the other words share.
    classes: int = 2048
    size: int = 24
    noise: int = 64
    batch: int = 2048
    rate: float = 0.2
    #: Where Adagrad's sums of squares start: early steps stay small.
    calm: float = 50.0
    seed: int = 11
    #: Documents, about, of the one-task warm-up that all blocks start from before they visit all documents.
    warm_docs: int = 3000

    @property
    def tails(self) -> int:
        return self.classes // 2


def tail_of(words: Iterable[bytes], tails: int) -> np.ndarray:
    """The number among the shared classes of each word."""
    return np.fromiter((crc32(w[:2] + w[-2:]) % tails for w in words), np.int64)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


@frugal
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
        seen.clear()
        return batch

    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(tokens(text))
            seen[b""] += 1
            if len(seen) > FLUSH_WORDS:
                yield out()
    yield out()


@frugal
def _mass(batches: Iterator[pa.RecordBatch], own: frozenset[bytes], tails: int) -> Iterator[pa.RecordBatch]:
    """Tokens and distinct words of each shared class in counts (word, c)."""
    sums = np.zeros((2, tails), np.int64)
    for batch in batches:
        words = batch.column(0).to_pylist()
        shared = np.flatnonzero(np.fromiter((w not in own for w in words), bool, len(words)))
        cls = tail_of([words[i] for i in shared.tolist()], tails)
        np.add.at(sums[0], cls, batch.column(1).to_numpy(zero_copy_only=False)[shared])
        np.add.at(sums[1], cls, 1)
    at = np.flatnonzero(sums[1])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, sums[0][at], sums[1][at])], names=["cls", "c", "n"])


@dataclass
class Model:
    """The vocabulary's head with its counts, the classes' training tokens, and the class tables."""

    total: int  # training tokens
    distinct: int
    head: dict[bytes, int]
    count: np.ndarray  # of the head
    cls: np.ndarray  # of the head
    first_tail: int  # the shared classes' first
    mass: np.ndarray  # of each class: training tokens
    kinds: np.ndarray  # of each class: distinct words
    set: Settings
    r: np.ndarray | None = None
    c: np.ndarray | None = None
    q: np.ndarray | None = None
    b: np.ndarray | None = None

    @property
    def k(self) -> int:
        return len(self.mass)

    @property
    def noise(self) -> np.ndarray:
        """The unigram distribution of the classes, smoothed."""
        n = self.mass + ALPHA
        return n / n.sum()

    def start(self) -> None:
        rng, k, d = np.random.default_rng(self.set.seed), self.k, self.set.size
        self.r = rng.normal(0, 0.1, (k, d)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (k, d)).astype(np.float32)
        self.c = np.ones((2, d), np.float32)
        self.b = np.log(self.noise).astype(np.float32)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Places in the head, or -1."""
        return np.fromiter(map(self.head.get, words, repeat(-1)), np.int32, len(words))

    def classes_of(self, words: list[bytes], ids: np.ndarray) -> np.ndarray:
        out = self.cls[ids] if len(self.cls) else np.zeros(len(ids), np.int64)
        rare = np.flatnonzero(ids < 0)
        out[rare] = self.first_tail + tail_of([words[i] for i in rare.tolist()], self.set.tails)
        return out

    def sizes(self) -> np.ndarray:
        """Log10 of what a word's smoothed count is divided by for its share of its class; of own classes 0."""
        out = np.log10(self.mass + ALPHA * (self.kinds + 1))
        out[: self.first_tail] = 0
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.c, self.q, self.b)])

    def load(self, flat: np.ndarray) -> None:
        k, d = self.k, self.set.size
        at = np.cumsum([0, k * d, 2 * d, k * d, k])
        self.r, self.c, self.q, self.b = (flat[a:z].astype(np.float32).reshape(s) for a, z, s in zip(at, at[1:], [(k, d), (2, d), (k, d), (k,)], strict=False))

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """Natural-log tables T1[c1, w] and T2[c2, w] (with b)."""
        return (self.r * self.c[0]) @ self.q.T, (self.r * self.c[1]) @ self.q.T + self.b

    def normalisers(self) -> np.ndarray:
        """log10 Z[c1, c2]."""
        t1, t2 = self.scores()
        m1, m2 = t1.max(axis=1), t2.max(axis=1)
        z = np.exp(t1 - m1[:, None]) @ np.exp(t2 - m2[:, None]).T
        return ((np.log(z) + m1[:, None] + m2[None, :]) / np.log(10)).astype(np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 tables T1[c1, w], T2[c2, w] (with b) and log10 Z[c1, c2]."""
        t1, t2 = ((t / np.log(10)).astype(np.float32) for t in self.scores())
        return t1, t2, self.normalisers()


def _rows_sum(idx: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    order = np.argsort(idx, kind="stable")
    at = idx[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out = np.zeros((k, values.shape[1]), np.float32)
    out[at[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


class Trainer:
    """Adagrad on the noise-contrastive objective, with the noise words of a step shared by its tokens."""

    def __init__(self, model: Model, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        noise = model.noise
        self.edges, self.log_noise = np.cumsum(noise), np.log(noise).astype(np.float32)
        self.sums = [np.full(x.shape, model.set.calm, np.float32) for x in (model.r, model.c, model.q, model.b)]
        self.seen = 0

    def step(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> None:
        m, k = self.m, self.m.k
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(m.set.noise)), k - 1)
        shift = self.log_noise + np.float32(np.log(m.set.noise))
        r1, r2, qw, qn = m.r[c1], m.r[c2], m.q[w], m.q[noise]
        pred = m.c[0] * r1 + m.c[1] * r2
        with np.errstate(over="ignore"):
            good = 1 / (1 + np.exp((pred * qw).sum(axis=1) + m.b[w] - shift[w]))  # 1 - sigmoid
            bad = -1 / (1 + np.exp(-(pred @ qn.T + m.b[noise] - shift[noise])))
        gp = good[:, None] * qw + bad @ qn
        gq = _rows_sum(w, good[:, None] * pred, k)
        np.add.at(gq, noise, bad.T @ pred)
        gb = np.bincount(w, good, k).astype(np.float32)
        np.add.at(gb, noise, bad.sum(axis=0))
        gc = np.stack([(gp * r1).sum(axis=0), (gp * r2).sum(axis=0)])
        gr = _rows_sum(np.concatenate([c1, c2]), np.concatenate([gp * m.c[0], gp * m.c[1]]), k)
        for x, g, s in zip((m.r, m.c, m.q, m.b), (gr, gc, gq, gb), self.sums, strict=True):
            s += g * g
            x += m.set.rate * g / np.sqrt(s)
        self.seen += len(w)


def _contexts(cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token; ends stand before a document."""
    c1, c2 = np.empty_like(cls), np.empty_like(cls)
    c1[1:], c2[2:] = cls[:-1], cls[:-2]
    c2[:2] = END
    c1[starts], c2[starts] = END, END
    second = starts + 1
    c2[second[second < len(cls)]] = END
    return c1, c2


@frugal
def _train(batches: Iterator[pa.RecordBatch], model: Model, seed: int) -> Iterator[pa.RecordBatch]:
    model.load(model.flat())  # own copies
    part = TaskContext.get().partitionId()
    trainer, size = Trainer(model, seed + part), model.set.batch
    held: list[tuple] = []
    count = 0

    def steps(last: bool):
        nonlocal held, count
        w, c1, c2 = (np.concatenate(x) for x in zip(*held, strict=True))
        order = trainer.rng.permutation(len(w))
        stop = len(w) if last else len(w) - len(w) % size
        for at in range(0, stop, size):
            i = order[at : min(at + size, stop)]
            trainer.step(w[i], c1[i], c2[i])
        rest = order[stop:]
        held, count = ([(w[rest], c1[rest], c2[rest])] if len(rest) else []), len(rest)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = tokens(text)
            cls = np.append(model.classes_of(words, model.ids(words)), END)
            held.append((cls, *_contexts(cls, np.zeros(1, np.int64))))
            count += len(cls)
            if count >= 32 * size:
                steps(False)
    if held:
        steps(True)
    if trainer.seen:
        yield pa.RecordBatch.from_arrays([pa.array([trainer.seen], pa.int64()), pa.array([model.flat().tobytes()], pa.binary())], names=["n", "params"])


@frugal
def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, acc = 0, None
    for batch in batches:
        for n, params in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(params, np.float32).astype(np.float64) * n
            total, acc = total + n, x if acc is None else acc + x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([(acc / total).astype(np.float32).tobytes()], pa.binary())], names=["n", "params"])


PARAMS = "n long, params binary"


def _head(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The end's and the commonest words' counts, commonest first: HEAD words, give or take a few.

    A histogram of counts in fine logarithmic steps (some 4000 at most) tells from which count on words are few
    enough; of the step in which they become too many, a hash takes as many as there is room for. So the driver gets
    the head's rows and no candidates of each partition.
    """
    step = F.floor(F.log2("c") * 64).cast("int")
    inside, room = F.col("word") == F.lit(b""), HEAD
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        if r["n"] > room:
            inside |= (step == r["step"]) & (F.shiftrightunsigned(F.xxhash64("word"), 11) < int((1 << 53) * room / r["n"]))
            break
        least, room = r["step"], room - r["n"]
    if room < HEAD:
        inside |= step >= least
    rows = counts.where(inside).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def fit(train: DataFrame, settings: Settings | None = None) -> tuple[Model, DataFrame]:
    """The model, and the stored table of all training tokens' counts (word, c). train: one column text (binary)."""
    settings = settings or Settings()
    counts = stored(train.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = _head(counts)
    words, count = [w for w, _ in head], np.array([c for _, c in head], np.int64)
    own = [w for w in words if w != b""][: settings.classes - settings.tails - 1]
    place = {b"": END} | {w: i + 1 for i, w in enumerate(own)}
    mass, kinds = np.zeros((2, len(place) + settings.tails), np.int64)
    for w, c in head:
        if w in place:
            mass[place[w]], kinds[place[w]] = c, 1
    for r in counts.mapInArrow(partial(_mass, own=frozenset(place), tails=settings.tails), "cls long, c long, n long").groupBy("cls").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        mass[len(place) + r["cls"]], kinds[len(place) + r["cls"]] = r["c"], r["n"]
    tail = len(place) + tail_of(words, settings.tails)
    cls = np.array([place.get(w, t) for w, t in zip(words, tail.tolist(), strict=True)], np.int64)
    model = Model(total, distinct, {w: i for i, w in enumerate(words)}, count, cls, len(place), mass, kinds, settings)
    model.start()
    docs = train.count()
    if docs:
        rounds = [train.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, settings.warm_docs / docs))).repartition(1), train]
        for i, part in enumerate(rounds):
            blocks = part.mapInArrow(partial(_train, model=model, seed=settings.seed + 1000 * i), PARAMS)
            if i:
                blocks = stored(blocks, "blocks")
                some = max(1, int(blocks.count() ** 0.5))
                blocks = blocks.repartition(some).mapInArrow(_average, PARAMS).repartition(1).mapInArrow(_average, PARAMS)
            done = blocks.collect()
            if done:
                model.load(np.frombuffer(done[0]["params"], np.float32))
    return model, counts


@frugal
def _score(batches: Iterator[pa.RecordBatch], model: Model, normalisers: np.ndarray) -> Iterator[pa.RecordBatch]:
    t1, t2 = ((t / np.log(10)).astype(np.float32).ravel() for t in model.scores())
    z, k, sizes = normalisers.ravel(), model.k, model.sizes()
    base = np.log10((model.count + ALPHA) / (model.total + ALPHA * (model.distinct + 1)))
    share = np.where(model.cls >= model.first_tail, np.log10(model.count + ALPHA) - sizes[model.cls], 0.0) if len(model.cls) else np.zeros(0)
    end = model.head.get(b"", -1)
    base, share = np.append(base, 0.0), np.append(share, 0.0)  # -1: added where the count is known
    uid = TaskContext.get().partitionId() << 33
    kind = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def scored(docs: list, held: list, words: list[list[bytes]]) -> pa.RecordBatch:
        nonlocal uid
        n = np.array([len(w) + 1 for w in words])
        starts = np.cumsum(n) - n
        flat = [x for w in words for x in (*w, b"")]
        ids = model.ids(flat)
        ids[starts + n - 1] = end
        cls = model.classes_of(flat, ids)
        cls[starts + n - 1] = END
        c1, c2 = _contexts(cls, starts)
        lp = (t1[c1 * k + cls] + t2[c2 * k + cls] - z[c1 * k + c2]).astype(np.float64) + share[ids]
        if end < 0:
            lone = np.log10(ALPHA / (model.total + ALPHA * (model.distinct + 1)))
        plain = base[ids] if end >= 0 else base[ids] + np.where(cls == END, lone, 0.0)
        rare = np.flatnonzero((ids < 0) & (cls != END))
        keys = [flat[i] for i in rare.tolist()]
        row = uid + np.repeat(np.arange(len(n)), n)[rare]
        own = uid + np.arange(len(n))
        uid += len(n)
        sums = [np.add.reduceat(x, starts) for x in ((ids >= 0).astype(np.int64), plain, lp)]
        names = [f.name for f in kind]
        facts = pa.StructArray.from_arrays([pa.array(docs, pa.int64()), pa.array(held, pa.bool_()), pa.array(n, pa.int64()), *map(pa.array, sums)], names)
        nulls = pa.nulls(len(keys), kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys + [b" %d" % u for u in own.tolist()], pa.binary()), pa.array(np.concatenate([row, own])), pa.array(np.concatenate([sizes[cls[rare]], np.zeros(len(own))])), pa.concat_arrays([nulls, facts])],
            names=["word", "uid", "size", "doc"],
        )

    for batch in batches:
        docs, held, words, size = [], [], [], 0
        for d, h, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            w = tokens(text)
            docs.append(d)
            held.append(h)
            words.append(w)
            size += len(w)
            if size > 200_000:
                yield scored(docs, held, words)
                docs, held, words, size = [], [], [], 0
        if docs:
            yield scored(docs, held, words)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of docs (doc_id, held_out, text as binary).

    Each word outside the head goes to its count's row with its document's number; a document's own row has a key
    that no word can have. One shuffle by word and one of sums by document.
    """
    out = "word binary, uid long, size double, doc struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base: double, score: double>"
    parts = docs.select("doc_id", "held_out", "text").mapInArrow(partial(_score, model=model, normalisers=model.normalisers()), out)
    found = parts.join(counts, "word", "left")
    c, rare = F.coalesce("c", F.lit(0)), F.col("doc").isNull()

    alone = F.when(rare, F.log10(c + ALPHA)).otherwise(F.lit(0.0))
    base = F.coalesce("doc.base", F.lit(0.0)) + F.when(rare, alone - math.log10(model.total + ALPHA * (model.distinct + 1))).otherwise(F.lit(0.0))
    own = F.coalesce("doc.score", F.lit(0.0)) + F.when(rare, alone - F.col("size")).otherwise(F.lit(0.0))
    known = F.coalesce("doc.n_known", (rare & (c > 0)).cast("long"))
    flat = found.select("uid", F.col("doc.doc_id").alias("doc_id"), F.col("doc.held_out").alias("held_out"), F.col("doc.n_tokens").alias("n_tokens"), known.alias("n_known"), base.alias("base"), own.alias("own"))
    sums = flat.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("own").alias("score"))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def fit_and_score(docs: DataFrame, fold: int = 10, settings: Settings | None = None) -> DataFrame:
    """Learn from documents whose crc32 of the doc_id's text is no multiple of fold, and score all of them."""
    rest = F.crc32(docs["doc_id"].cast("string").cast("binary")) % fold
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(rest == 0, F.lit(False)).alias("held_out"), rest.isNotNull().alias("known_id"), text_of(docs).cast("binary").alias("text"))
    model, counts = fit(read.where(F.col("known_id") & ~F.col("held_out")).select("text"), settings)
    return score(read, model, counts)
