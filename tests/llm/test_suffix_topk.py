import hashlib
import random
from collections import Counter

import numpy as np

from quillfold.llm import suffix_dedup, topk


def plain_removed(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by a set of all strings seen so far."""
    seen, out = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        spans = []
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            if g in seen:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
            seen.add(g)
        at, kept = 0, b""
        for a, z in spans:
            kept, at = kept + b[at:a], z
        kept += b[at:]
        out[(i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())] += 1
    return out


def got_removed(df):
    return Counter(tuple(r) for r in suffix_dedup.dedup(df).collect())


def test_removal_against_plain_python(spark, docs, rows):
    assert got_removed(docs) == plain_removed([(r[0], r[1]) for r in rows])


def test_edges_periods_and_shared_passages(spark):
    rnd = random.Random(9)

    def noise(n):
        return "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))

    passage, line = noise(180), noise(60)
    rows = [(i, noise(rnd.randint(0, 300)) + passage[rnd.randint(0, 60) : rnd.randint(120, 180)] + noise(50) + line + noise(rnd.randint(0, 90))) for i in range(80)]
    rows += [(100, "a" * 99), (101, "a" * 100), (102, "a" * 101), (103, "ab" * 400), (104, "b" + "ab" * 60), (105, "x" * 3000)]
    rows += [(110, noise(300)), (111, None), (112, "")]
    rows += [(113, rows[-3][1]), (114, rows[-3][1][50:250]), (115, rows[-3][1][:99]), (116, "é" * 120), (117, "é" * 49), (118, "q" + "é" * 60)]
    base = noise(400)
    rows += [(200 + k, base[:k] + "#" + base[k + 1 :]) for k in range(0, 400, 23)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, key string, pos int").repartition(5)
    assert got_removed(df) == plain_removed(rows)


def test_text_longer_than_a_segment(spark):
    rnd = random.Random(3)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(150_000))
    rows = [(1, part + part + "tail"), (2, part[70_000:] + "other"), (3, "no")]
    want = plain_removed(rows)
    assert got_removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)) == want


def test_equal_rows_and_shared_ids(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefg ") for _ in range(250))
    rows = [(1, text), (1, text), (1, "short"), (1, "short"), (2, text), (None, "n" * 10)]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == Counter({(1, 250, 0): 1, (1, 250, 250): 1, (1, 5, 0): 2, (2, 250, 250): 1, (None, 10, 0): 1})


def test_removal_empty(empty):
    assert suffix_dedup.dedup(empty).collect() == []


def plain_topk(rows, every=50, k=5):
    valid = {}
    cands = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256.0 * float(np.float32(x)))) for x in v]
        cands.append((i, q))
        if i % every == 0:
            valid.setdefault(i, q)
    out = set()
    for i, q in valid.items():
        scores = sorted(((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in cands if j != i))[:k]
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    return out


def test_topk_against_plain_python(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([0.0, 0.0, rnd.uniform(-2, 2)]) for _ in range(12)]) for i in range(400)]
    rows += [(400, None), (450, [1.0, None] + [0.0] * 10), (500, [float("nan")] * 12), (550, [float("inf")] * 12), (600, []), (650, [1.0] * 5), (None, [1.0] * 12)]
    rows += [(700 + i, rows[3][1]) for i in range(20)]  # ties
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(4)
    got = {tuple(r) for r in topk.nearest(df).collect()}
    assert got == plain_topk(rows)


def test_topk_sparse_scatter_and_few_rows(spark):
    dense = np.array([[3, 0, 2], [0, 0, 1]])
    rows = np.zeros((50, 3), np.int64)
    rows[7] = [5, 1, 1]
    rows[9, 2] = 4
    assert (topk.accumulate(dense, rows) == dense @ rows.T).all()
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"]) for r in sorted(topk.nearest(few).collect(), key=lambda r: r["rank"])] == [(1, 1), (2, 2)]


def test_topk_empty(spark):
    assert topk.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
