from collections import Counter, defaultdict

import pytest
from conftest import plain_words  # noqa: F401

from quillfold.llm import mixing, quality


def test_mix_targets_and_limits(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    want = defaultdict(int)
    for _, t, _, s in rows:
        want[s] += len(plain_words(t))
    assert dict(sizes) == dict(want)
    # reshare by rounds, as the contract words it
    order = sorted(want, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    free, left, plain = set(order), 1.5 * sum(want.values()), {}
    while free:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > 2 * want[s]]
        if not over:
            plain |= part
            break
        for s in over:
            plain[s] = 2 * want[s]
            left -= plain[s]
            free.remove(s)
    for s in order:
        assert goal[s] == pytest.approx(plain[s])
        assert abs(taken[s] - goal[s]) <= max(len(plain_words(t)) for _, t, _, x in rows if x == s)
    again = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["size"]): r["taken"] for r in got}


def test_mix_empty_and_wordless(spark, empty):
    assert mixing.mix(empty).collect() == []
    one = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r["size"], r["taken"], r["target"]) for r in mixing.mix(one).collect()) == [(0, 0, 0.0), (0, 0, 0.0)]


def plain_rules(text):
    text = text or ""
    w = plain_words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if plain_words(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed)


def test_quality_against_plain_python(docs, rows):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.judge(docs).collect())
    assert got == Counter((i, *plain_rules(t)) for i, t, _, _ in rows)


def test_host_verdicts_shrink_small_hosts(spark):
    rows = [(i, "w%d " % i * 1, "bad") for i in range(200)] + [(1000 + i, " ".join(f"a{k}" for k in range(60)), f"h{i % 9}") for i in range(900)] + [(5000, "short", "tiny")]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    rate = {r["source"]: r["host_rate"] for r in got}
    assert rate["bad"] > 0.8 > rate["tiny"] > rate["h1"]
    assert all(r["kept"] == (r["doc_id"] >= 1000 and r["doc_id"] < 5000) for r in got)


def test_each_rule_judges_hosts(spark):
    good = [f"a{k}" for k in range(60)]
    bad = {"symbols": " ".join([*good, "#" * 20]), "dup_lines": "\n".join([" ".join(good), *["same line again"] * 4]), "words": "too few"}
    rows = [(100 * i + k, t if k < 80 else " ".join(good), host) for i, (host, t) in enumerate(bad.items()) for k in range(100)]
    rows += [(1000 + k, " ".join(good) if k % 4 else bad["symbols"], ("fine", None)[k % 2]) for k in range(400)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] >= 1000) for r in got)
    assert {r["source"] for r in got if r["base_failed"]} == {"words"}


def test_mixing_carries_columns_of_any_name(spark):
    names = "bits copies below copy plan plan_source size h target bucket fp label leaf row rejected score".split()
    docs = spark.range(40).selectExpr("id as doc_id", "concat('w ', id) as text", "if(id % 2 = 0, 'a', null) as source", *[f"id as {n}" for n in names])
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.count() > 40
    assert got.where(" or ".join(f"{n} <> doc_id" for n in names)).count() == 0


def test_quality_empty(empty):
    assert quality.judge(empty).collect() == []
