import random

import corpus_pipeline
import pytest

from quillfold.llm import near_copies, simhash


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_labels(texts, least=0.8):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (a and b and 10 * len(a & b) >= 10 * least * len(a | b)):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(sets))]


def near_texts():
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    texts = []
    for i in range(150):  # copies of 0.6 to 0.95: changed tails, so that similarity is graded finely
        w = [rnd.choice(words) for _ in range(rnd.randint(12, 200))]
        cut = max(1, int(len(w) * rnd.uniform(0.02, 0.22)))
        texts += [" ".join(w), " ".join(w[:-cut] + [rnd.choice(words) for _ in range(cut)])]
    base = [rnd.choice(words) for _ in range(120)]
    for i in range(60):  # one group of near copies, chained, and a shared passage
        texts.append(" ".join([*base, *(rnd.choice(words) for _ in range(i))]))
    return [*texts, "", None, "a b", "A  b", "one two three four"]


@pytest.mark.parametrize("hot_least", [4, 1024])
def test_classes_are_those_of_exact_similarity(spark, monkeypatch, hot_least):
    texts = near_texts()
    # a passage that a third of all documents hold
    texts = [f"{t} {texts[-10]}" if t and i % 3 == 0 and i < 300 else t for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = plain_labels(texts)
    monkeypatch.setattr(simhash, "TILE", 16)
    got = {r["doc_id"]: r["label"] for r in near_copies.labelled(df, hot_least=hot_least).collect()}
    pairs = {(want[i], got[i]) for i in range(len(texts))}
    assert len(pairs) == len(set(want)) == len(set(got.values()))


def test_the_stage_keeps_what_is_not_similar_enough(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == set(plain_labels(texts))


def test_one_row_a_class_whatever_its_ids(spark):
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(30)) for _ in range(12)]
    rows = [(None, t) for t in texts[:6]] + [(None, texts[0]), (None, texts[8])] + [(7, t) for t in texts[6:10]] + [(9, texts[10]), (9, texts[10]), (3, texts[11])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(rows[:6] + rows[8:12] + [rows[12], rows[14]], key=str)
    for kept in (simhash.representatives(df), corpus_pipeline.near_dedup(spark, df, "")):
        assert sorted(map(tuple, kept.collect()), key=str) == want
