"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ORDER within words, which are padded by a start mark. Highest-order
counts are plain, lower orders count distinct predecessors; each order is discounted and interpolated with the next.
All n-grams are kept as sorted arrays of hashes with one column of log probabilities a language, and what a missing
n-gram falls back to as sorted arrays of context hashes with the languages' back-off weights. A text's score in a
language is its mean log probability per character; the best language wins. A text is rejected if even its best
cross-entropy lies far above what that language's own texts had in calibration, more so the longer the text.

The models are fitted on a bounded sample of labelled documents: about `per_language` of each language (all, if
fewer), chosen by hash. A fifth of them calibrates. The table keeps all n-grams of the sample, so that no language
loses its own to others'. All documents are scored, whole.

Cases: null text, and text without a letter, is `und` with score 0, rejected; null or missing labels are not learned
from; without any labelled text every language is `und`; runs of over CHUNK letters are scored in chunks; ties go to
the language first in code-point order; repeated rows each give a row; an empty table gives an empty result; other
columns are carried along or not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import frugal, text_of

ORDER = 4
DISCOUNT = 0.75
START = "\x02"
STOP = " "
CHUNK = 64
MAX_LANGUAGES = 500
CACHE_WORDS = 250_000
UND = "und"

_WORD = re.compile(r"[^\W\d_]+")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def letters(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if there is no letter."""
    found = _WORD.findall(text.lower()) if text else []
    if found and not any(any(c.isalpha() for c in w) for w in found):
        return []
    if any(len(w) > CHUNK for w in found):
        found = [w[i : i + CHUNK] for w in found for i in range(0, len(w), CHUNK)]
    return found


def _hash(points: np.ndarray, order: int) -> np.ndarray:
    """Of each row's last `order` code points."""
    h = np.full(len(points), order, np.uint64)
    for k in range(order):
        h = (h + points[:, points.shape[1] - order + k]) * _MIX[k % 4]
        h ^= h >> np.uint64(29)
    return h


def _windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER code points at each place of the words and their stops, and each word's first place."""
    text = "".join(START * (ORDER - 1) + w + STOP for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = np.array([len(w) + 1 for w in words])
    starts = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat((np.arange(len(n)) + 1) * (ORDER - 1), n)
    return np.stack([points[at - ORDER + 1 + k] for k in range(ORDER)], axis=1), starts


@dataclass
class Model:
    languages: list[str]
    #: by order, ORDER first: sorted hashes of seen n-grams, log10 probability a language
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: by order: sorted hashes of seen contexts, log10 back-off weight a language
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: float = -6.0
    #: a language's mean cross-entropy in calibration and its spread for a text of one word
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None
    #: how much more margin a text of few words gets
    leniency: float = 4.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        points, starts = _windows(words)
        out = np.zeros((len(points), len(self.languages)), np.float32)
        open_ = np.arange(len(points))
        for k in range(ORDER):
            order = ORDER - k
            keys, values = self.grams[k]
            h = _hash(points[open_], order)
            at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
            hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
            out[open_[hit]] += values[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            keys, values = self.contexts[k]
            h = _hash(points[open_][:, :-1], order - 1)
            at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
            hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
            out[open_[hit]] += values[at[hit]]
        out[open_] += self.floor
        return np.add.reduceat(out, starts, axis=0)


def build(counts: dict[str, Counter]) -> Model:
    """The models from each language's counts of ORDER-character windows."""
    languages = sorted(counts)
    probability = [[{} for _ in languages] for _ in range(ORDER)]  # by order from ORDER down, language: gram -> p
    weight = [[{} for _ in languages] for _ in range(ORDER)]  # context -> share left to the next order
    alphabet = max(1, len({g[-1] for c in counts.values() for g in c}))
    for i, lang in enumerate(languages):
        tables = [dict(counts[lang])]
        for order in range(ORDER - 1, 0, -1):
            lower: dict[str, int] = defaultdict(int)
            for g in tables[-1]:
                lower[g[1:]] += 1
            tables.append(lower)
        for k in range(ORDER - 1, -1, -1):  # from single characters up
            sums, kinds = defaultdict(int), defaultdict(int)
            for g, n in tables[k].items():
                sums[g[:-1]] += n
                kinds[g[:-1]] += 1
            below = probability[k + 1][i] if k + 1 < ORDER else None
            weight[k][i] = {c: DISCOUNT * kinds[c] / sums[c] for c in sums}
            probability[k][i] = {g: (n - DISCOUNT) / sums[g[:-1]] + weight[k][i][g[:-1]] * (below[g[1:]] if below else 1 / (alphabet + 1)) for g, n in tables[k].items()}
    floor = 1 / (alphabet + 1)
    model = Model(languages, floor=float(np.log10(floor)))

    def prob(k: int, i: int, g: str) -> float:
        p = 1.0
        while k < ORDER:
            if g in probability[k][i]:
                return p * probability[k][i][g]
            p *= weight[k][i].get(g[:-1], 1.0)
            k, g = k + 1, g[1:]
        return p * floor

    for k in range(ORDER):
        order = ORDER - k
        for names, values, make, size in ((probability, model.grams, prob, order), (weight, model.contexts, lambda k, i, c: weight[k][i].get(c, 1.0), order - 1)):
            union = sorted(set().union(*[d.keys() for d in names[k]]))
            if not union:
                values.append((np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32)))
                continue
            points = np.array([[ord(c) for c in g] for g in union], np.uint64).reshape(len(union), size)
            h = _hash(points, size)
            table = np.array([[np.log10(make(k, i, g)) for i in range(len(languages))] for g in union], np.float32)
            keys, at = np.unique(h, return_index=True)
            values.append((keys, table[at]))
    return model


class Scorer:
    """Sums of cached word scores over texts."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.table = np.zeros((0, len(model.languages)), np.float32)

    def totals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each text (of one word at least) by language, and its characters, stops included."""
        need: set[str] = set()
        for t in texts:
            need.update(t)
        new = [w for w in need if w not in self.place]
        if len(new) + len(self.place) > CACHE_WORDS:
            self.place, self.table, new = {}, self.table[:0], list(need)
        if new:
            at = len(self.table)
            self.table = np.concatenate([self.table, *(self.model.word_scores(new[i : i + 20_000]) for i in range(0, len(new), 20_000))])
            self.place.update(zip(new, range(at, at + len(new)), strict=True))
        n = np.array([len(t) for t in texts])
        flat = [w for t in texts for w in t]
        rows = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        chars = np.fromiter(map(len, flat), np.int64, len(flat)) + 1
        starts = np.cumsum(n) - n
        return np.add.reduceat(self.table[rows], starts, axis=0, dtype=np.float64), np.add.reduceat(chars, starts)


def _sampled(labelled: DataFrame, per_language: int) -> DataFrame:
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = F.lit(0.0)
    for r in found:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["n"]))).otherwise(share)
    u = F.shiftrightunsigned(F.xxhash64(F.lit(5), "text"), 11) / F.lit(float(1 << 53))
    return labelled.where(u < share).withColumn("fold", F.pmod(F.xxhash64(F.lit(9), "text"), F.lit(5)).cast("int"))


@frugal
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words[lang].update(letters(text))
        rows = []
        for lang, seen in words.items():
            grams: Counter = Counter()
            for w, n in seen.items():
                padded = START * (ORDER - 1) + w + STOP
                for i in range(len(w) + 1):
                    grams[padded[i : i + ORDER]] += n
            rows += [(lang, g, n) for g, n in grams.items()]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["lang", "gram", "n"])


@frugal
def _entropies(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer, index = Scorer(model), {x: i for i, x in enumerate(model.languages)}
    for batch in batches:
        kept = [(x, w) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x in index and (w := letters(t))]
        if not kept:
            continue
        total, chars = scorer.totals([w for _, w in kept])
        own = [index[x] for x, _ in kept]
        ce = -total[np.arange(len(kept)), own] / chars
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept]), pa.array(ce), pa.array([float(len(w)) for _, w in kept])], names=["lang", "ce", "words"])


def fit(labelled: DataFrame, per_language: int = 2000) -> Model:
    """From labelled (text, lang); rows with a null in either are left out."""
    some = _sampled(labelled.select(labelled["lang"].cast("string").alias("lang"), labelled["text"].cast("string").alias("text")).where("lang is not null and text is not null"), per_language)
    grams = some.where("fold > 0").select("lang", "text").mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = defaultdict(Counter)
    for r in grams.toLocalIterator():
        counts[r["lang"]][r["gram"]] = r["n"]
    model = build(counts)
    model.usual, model.spread = np.full(len(counts), 2.0), np.full(len(counts), 1.0)
    if counts:
        seen = some.where("fold = 0").select("lang", "text").mapInArrow(partial(_entropies, model=model), "lang string, ce double, words double")
        facts = seen.where("words >= 20").groupBy("lang").agg(F.percentile("ce", F.lit(0.5)).alias("mid"), F.percentile("ce", F.lit(0.95)).alias("high"), F.count("*").alias("n"))
        for r in facts.collect():
            i = model.languages.index(r["lang"])
            # the margin that 95 of 100 of its own texts keep within, threefold, and never under 0.6 of the usual
            model.usual[i] = r["mid"]
            model.spread[i] = 1.0 if r["n"] < 20 else max(3 * (r["high"] - r["mid"]), 0.6 * r["mid"])
    return model


@frugal
def _predict(batches: Iterator[pa.RecordBatch], model: Model, text_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    scorer, labels = Scorer(model), np.array([*model.languages, UND], dtype=object)
    und = len(model.languages)
    for batch in batches:
        texts = batch.column(text_at).to_pylist()
        n = len(texts)
        best, score, ce, rejected = np.full(n, und), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        at = 0
        while at < n and und:
            rows, words, size = [], [], 0
            while at < n and size < 200_000:
                w = letters(texts[at])
                if w:
                    rows.append(at)
                    words.append(w)
                    size += len(w)
                at += 1
            if not rows:
                continue
            total, chars = scorer.totals(words)
            top = total.argmax(axis=1)
            near = total - total.max(axis=1, keepdims=True)
            # per-character evidence, of 30 characters at most: long texts do not make the score certain by length alone
            share = np.power(10.0, near * (np.minimum(chars, 30) / chars)[:, None])
            best[rows], score[rows] = top, 1 / share.sum(axis=1)
            ce[rows] = -total[np.arange(len(rows)), top] / chars
            many = np.clip(chars / 5, 1, 400)  # words, about
            rejected[rows] = ce[rows] > model.usual[top] + model.spread[top] * (1 + model.leniency / np.sqrt(many))
        made = [pa.array(labels[best], pa.string()), pa.array(score), pa.array(ce, from_pandas=True), pa.array(rejected)]
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, "lang_pred", "score", "cross_entropy", "rejected"])


def _judged(docs: DataFrame, model: Model, keep: list[str], text: str) -> tuple[DataFrame, list[str]]:
    """The columns `keep` under names of their own, which come second, and what predict adds."""
    held = [docs[c].alias(f"c{i}") for i, c in enumerate(keep)]
    again = text in keep and docs.schema[text].dataType.simpleString() == "string"  # then it travels once
    read = docs.select(*held, *([] if again else [docs[text].cast("string").alias("t")]))
    names = [f"c{i}" for i in range(len(keep))]
    schema = ", ".join([f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True)] + ["lang_pred string", "score double", "cross_entropy double", "rejected boolean"])
    return read.mapInArrow(partial(_predict, model=model, text_at=keep.index(text) if again else len(keep), names=names), schema), names


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns `keep` (default: doc_id) and lang_pred, score, cross_entropy and rejected."""
    keep = ["doc_id"] if keep is None else keep
    done, names = _judged(docs, model, keep, text)
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "lang_pred", "score", "cross_entropy", "rejected")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with columns of any names, that the models do not reject."""
    judged, names = _judged(docs, model, docs.columns, "text")
    return judged.where(~F.col("rejected")).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def fold(doc_id: Column, folds: int) -> Column:
    """The remainder of crc32 of the id's text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of all documents, learned from those not held out."""
    rest = fold(docs["doc_id"], folds)
    model = fit(docs.where(rest != held).select("text", "lang"))
    marked = docs.select("doc_id", "text", F.coalesce(rest == held, F.lit(False)).alias("held_out"))
    return predict(marked, model, ["doc_id", "held_out"])
