import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quillfold.llm import langid, lm_score


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_base_scores_against_plain_python(docs, rows):
    got = lm_score.fit_and_score(docs).collect()
    assert len(got) == len(rows)
    toks = [(i, (t or "").encode().lower().split() + [b""]) for i, t, _, _ in rows]
    train = Counter(x for i, w in toks if i is not None and fold(i, 10) for x in w)
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, w in toks:
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i, i is not None and fold(i, 10) == 0, len(w), sum(train[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_model_is_a_distribution_and_learns(spark):
    rnd = random.Random(3)
    chains = ["alpha beta gamma delta".split(), "uno dos tres cuatro".split()]
    texts = []
    for i in range(400):
        c = chains[i % 2]
        texts.append((i, " ".join(c[(k + i) % 4] for k in range(40)) + (f" rare{rnd.randint(0, 60)}" if i % 3 else "")))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    settings = lm_score.Settings(classes=8, size=8, batch=256)
    train = df.selectExpr("cast(text as binary) as text")
    model, counts = lm_score.fit(train, settings)
    t1, t2, z = model.tables()
    total = (10.0 ** (t1[:, None, :] + t2[None, :, :] - z[:, :, None])).sum(axis=2)
    assert np.allclose(total, 1, atol=1e-3) and model.k == 8
    # a tail class's shares over its words and one unseen word are a distribution too
    seen = {bytes(r["word"]): r["c"] for r in counts.collect()}
    by_class = {}
    for w, c in zip(seen, model.classes_of(list(seen), model.ids(list(seen))).tolist(), strict=True):
        by_class.setdefault(c, []).append(seen[w])
    assert all(len(by_class[c]) == 1 for c in range(model.first_tail))
    for c in range(model.first_tail, model.k):
        assert math.isclose(sum(n + 0.1 for n in [*by_class.get(c, []), 0]), 10 ** model.sizes()[c])
    scored = lm_score.fit_and_score(df, settings=settings).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert scored[0] > 0.8 * scored[1]  # log probabilities: nearer to 0 is better


def test_scores_against_plain_python(docs, rows):
    """Every token's probability from the model's parameters by sums over all classes, without tables."""
    read = docs.selectExpr("doc_id", "false as held_out", "cast(coalesce(text, '') as binary) as text")
    settings = lm_score.Settings(classes=40, size=6, batch=256)
    model, counts = lm_score.fit(read.select("text"), settings)
    seen = {bytes(r["word"]): r["c"] for r in counts.collect()}
    order = sorted((w for w in seen if w), key=lambda w: (-seen[w], w))[:19]
    tail = lambda w: 20 + zlib.crc32(w[:2] + w[-2:]) % 20
    cls = lambda w: 0 if w == b"" else order.index(w) + 1 if w in order else tail(w)
    words_of, memo = Counter(), {}
    mass = Counter()
    for w, c in seen.items():
        words_of[cls(w)] += 1
        mass[cls(w)] += c

    def log_p(a, b, w):
        if (a, b) not in memo:
            e = np.exp((model.c[0] * model.r[a] + model.c[1] * model.r[b]).astype(float) @ model.q.T.astype(float) + model.b)
            memo[a, b] = np.log10(e / e.sum())
        k = cls(w)
        return memo[a, b][k] + (math.log10((seen[w] + 0.1) / (mass[k] + 0.1 * (words_of[k] + 1))) if k >= 20 else 0)

    want = Counter()
    for i, t, _, _ in rows:
        w = [*(t or "").encode().lower().split(), b""]
        c = [0, 0, *map(cls, w)]
        want[(i, round(sum(log_p(c[j + 1], c[j], x) for j, x in enumerate(w)), 1))] += 1
    got = Counter((r["doc_id"], round(r["score"], 1)) for r in lm_score.score(read, model, counts).collect())
    off = [x for x in got if x not in want and (x[0], round(x[1] + 0.1, 1)) not in want and (x[0], round(x[1] - 0.1, 1)) not in want]
    assert not off and sum(got.values()) == len(rows)


def test_rare_words_are_told_from_each_other_on_held_out_text(spark):
    """With 31 words of their own class among 900, the other words' classes must tell which tongue goes on."""
    rnd = random.Random(5)
    texts = []
    for i in range(600):
        p = rnd.choice(["ka", "lo", "mi"])
        texts.append((i, " ".join(f"{p}{rnd.randrange(300)}x" for _ in range(60))))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = lm_score.fit_and_score(df, settings=lm_score.Settings(classes=64, size=12, batch=64)).where("held_out").selectExpr("sum(score)", "sum(base_score)", "sum(n_tokens)").first()
    assert (got[0] - got[1]) / got[2] > 0.24  # knowing the tongue is worth log10(3) = 0.48 a word at most


def test_score_empty_and_untrained(spark, empty):
    assert lm_score.fit_and_score(empty).collect() == []
    held = next(i for i in range(1000) if fold(i, 10) == 0)
    one = lm_score.fit_and_score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert one[0]["n_tokens"] == 3 and one[0]["n_known"] == 0 and one[0]["train_tokens"] == 0 and one[0]["base_score"] == 0


@pytest.fixture(scope="module")
def tongues(spark):
    rnd = random.Random(8)
    parts = {"en": "th er on an re he in ed nd ha at en es of or".split(), "es": "ci ón ar do ez la os ñ ar ue ll a que".split(), "de": "ch ei ung sch ver ß ü er en ge".split()}
    rows = []
    for i in range(600):
        lang = rnd.choice(list(parts))
        n = rnd.choice([12, 40, 120])
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))
        rows.append((i, text, None if i % 17 == 0 else lang, lang))
    extra = [(1000, None, "en", None), (1001, "12 34 !", "en", None), (1002, "これは日本語の文章です" * 20, None, None), (None, rows[0][1], "en", rows[0][3]), (3, rows[3][1], rows[3][2], rows[3][3])]
    return rows + extra, spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, score string").repartition(3)


def test_held_out_accuracy_and_rejection(tongues):
    rows, df = tongues
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    truth = {(i, t): x for i, t, _, x in rows}
    by_id = {r["doc_id"]: r for r in got}
    held = [r for r in got if r["held_out"] and r["doc_id"] < 1000]
    assert len(held) > 100 and all(fold(r["doc_id"], 4) == 2 for r in held)
    real = {i: x for (i, _), x in truth.items()}
    assert sum(r["lang_pred"] == real[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert by_id[1000]["lang_pred"] == by_id[1001]["lang_pred"] == "und" and by_id[1001]["score"] == 0
    assert by_id[1002]["rejected"] and by_id[1002]["lang_pred"] in ("de", "en", "es")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["rejected"] for r in got if r["doc_id"] is not None and r["doc_id"] < 1000) == 0


def test_kneser_ney_sums_to_one():
    counts = {"x": Counter({"\x02\x02\x02a": 3, "\x02\x02ab": 2, "\x02\x02ac": 1, "\x02abb": 1, "\x02ab ": 1, "abb ": 1, "\x02ac ": 1})}
    model = langid.build(counts)
    alphabet = ["a", "b", "c", " "]
    for context in ("\x02\x02\x02", "\x02\x02a", "\x02ab", "zzz"):
        p = 0.0
        for c in [*alphabet, "?"]:
            points = np.array([[ord(x) for x in context + c]], np.uint64)
            total, open_ = 0.0, True
            for k in range(langid.ORDER):
                keys, values = model.grams[k]
                h = langid._hash(points, langid.ORDER - k)
                if h[0] in keys:
                    total, open_ = total + values[keys == h[0]][0, 0], False
                    break
                keys, values = model.contexts[k]
                h = langid._hash(points[:, :-1], langid.ORDER - k - 1)
                if h[0] in keys:
                    total += values[keys == h[0]][0, 0]
            p += 10 ** (total + (model.floor if open_ else 0))
        assert math.isclose(p, 1, rel_tol=1e-4), context


def test_langid_empty_and_unlabelled(spark, empty):
    assert langid.identify(empty).collect() == []
    got = langid.identify(spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")).collect()
    assert got[0]["lang_pred"] == "und"
