import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import xxhash
from conftest import plain_words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillfold.llm import packing, simhash


PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 2.0, None: 1.0}])
def test_pack_round_trip(docs, rows, weights):
    got = packing.pack(docs, window=128, weights=weights).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    want = Counter()
    for i, t, _, _ in rows:
        want[i] += 1
    ids = {i: plain_ids(t) for i, t, _, _ in rows}
    for i, times in want.items():
        at = Counter()
        for start, n, crc, total in pieces[i]:
            assert total == len(ids[i])
            part = ids[i][start : start + n]
            assert zlib.crc32(struct.pack(f"<{n}I", *part)) == crc
            at.update(range(start, start + n))
        assert at == {k: times for k in range(len(ids[i]))}
    lengths = []
    for w in range(len(windows)):
        at = 0
        for offset, n in sorted(windows[w]):
            assert offset == at
            at += n
        lengths.append(at)
    assert all(n == 128 or (n & (n - 1)) == 0 for n in lengths) and sum(n != 128 for n in lengths) <= 7


AWKWARD = st.text(alphabet=st.one_of(st.sampled_from(" \t\n'sAÉéaz09.,-_/<|>\u00a0日本ー한ا\u0301🙂"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(AWKWARD, st.sampled_from(["<|endoftext|>", "<|endof", " ", "it's", "日本語"])), max_size=6))
def test_ids_are_the_files_own(parts):
    text = "".join(parts)
    got = packing.tokenizer(None).encode([text])[0]
    assert [*struct.unpack(f"<{len(got) // 4}I", got)] == PLAIN.encode(text, add_special_tokens=False).ids


def test_added_tokens_keep_their_id():
    for text in ("hello <|endoftext|> world", "日本語 テスト <|endoftext|>", "<|endoftext|>", "a<|endoftext|>b"):
        got = packing.tokenizer(None).encode([text])[0]
        assert 50256 in struct.unpack(f"<{len(got) // 4}I", got) and [*struct.unpack(f"<{len(got) // 4}I", got), 0] == plain_ids(text)


def test_windows_keep_proportions():
    totals = [70_000, 20_000, 7, 10_000]
    plan = packing.Plan(totals, None, 1024)
    for w in range(1, plan.full):
        c = plan.begin(np.array([w]))
        for s, n in enumerate(totals):
            own = int(plan.dealt(0, np.array([s]), c)[1][0])
            assert abs(own - w * 1024 * n / sum(totals)) <= 3
    big = packing.Plan([n * 10**12 for n in totals], None, 1024)
    assert big.kind is object and int(big.dealt(0, np.array([0]), big.begin(np.array([10**9])))[1][0]) == pytest.approx(1024e9 * 7 / 10.0007, rel=1e-3)


def test_weighted_windows_follow_weights(spark):
    rows = [(i, "word " * 200, "ab"[i % 2]) for i in range(40)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), window=100, weights={"a": 3.0, "b": 1.0}).collect()
    early = Counter()
    for r in got:
        if r["sequence_id"] < 20:
            early[r["source"]] += r["length"]
    assert early["a"] / 2000 == pytest.approx(0.75, abs=0.01)


def test_pack_empty(empty):
    assert packing.pack(empty).collect() == []


def plain_print(text):
    w = [x.encode().lower() for x in plain_words(text)]
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(prints, radius=3):
    ids = list(prints)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_simhash_against_plain_python(docs, rows):
    got = simhash.classes(docs).collect()
    assert len(got) == len(rows)
    prints = {i: plain_print(t) for i, t, _, _ in rows if i is not None}
    want = plain_classes(prints)
    for r in got:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
            assert r["component_id"] == want[r["doc_id"]]


def test_near_matches_popcount():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    block = np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) ^ np.uint64(k) for b in (0, 9, 60) for k in (0, 3, 7, 255)])
    sizes = np.array([1, 70, 129, 2, len(block) - 202])
    for radius in (1, 3, 5, 7):
        for g, hit in zip(np.split(block, np.cumsum(sizes)[:-1]), simhash.near(block[:, None], sizes, radius), strict=True):
            hit = np.unpackbits(hit.view(np.uint8), bitorder="little", axis=1)[:, : len(g)]
            want = np.array([[int(a ^ b).bit_count() <= radius for b in g.tolist()] for a in g.tolist()])
            assert (hit.astype(bool) == want).all()


def test_wide_fingerprints_find_near_copies(spark):
    import random

    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(5000)]
    rows, pairs = [], []
    for i in range(120):
        w = [rnd.choice(words) for _ in range(rnd.randint(60, 300))]
        other = list(w)
        for k in rnd.sample(range(len(w)), max(1, len(w) // 60)):
            other[k] = "changed"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
        a, b = ({tuple(v[k : k + 5]) for k in range(len(v) - 4)} for v in (w, other))
        if len(a & b) / len(a | b) >= 0.8:
            pairs.append(i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(df, span=5, limbs=4, radius=48).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in pairs) >= 0.9 * len(pairs) > 50
    assert all(v // 2 == k // 2 for k, v in got.items())
    assert simhash.representatives(df, span=5, limbs=4, radius=48).count() == len(set(got.values()))


def test_links_of_large_buckets_and_chains(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(5)
    prints = set()
    for start in rng.integers(0, 1 << 62, 6).tolist():
        x = start
        for _ in range(40):  # a chain: each 3 bits from the one before
            for b in rng.choice(64, 3, replace=False).tolist():
                x ^= 1 << b
            prints.add(x)
    prints |= {(7 << 50) ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}  # one dense group
    named = {x - (1 << 64) if x >> 63 else x: x for x in prints}
    df = spark.createDataFrame([(v, [v]) for v in named], "fp long, limbs array<long>")
    labels = {r["node"]: r["label"] for r in simhash.components(simhash.links(df)).collect()}
    want = plain_classes(named)
    groups = defaultdict(set)
    for v in named:
        groups[want[v]].add(labels.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_empty(empty):
    assert simhash.classes(empty).collect() == []
