"""Rule tables: one row a case, with the cases that must not pass."""

import pytest
from pyspark.sql import functions as F

from quillfold.functions import rules, udfs
from quillfold.functions import text as t
from quillfold.functions.codecs import bucket_and_key, decode_position, html_escaped, percent_encoded, position
from quillfold.functions.scores import nearest_rank, platt, wilson


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    ("new", "old", "same", "rejected", "want"),
    [
        ("5", None, False, False, "none"),
        (None, None, False, False, "INVALID"),
        ("5", "5", True, False, "same"),
        ("6", "5", True, False, "same"),
        ("6", "5", False, False, "newer"),
        ("4", "5", False, False, "STALE"),
        ("4", "5", True, False, "STALE"),
        ("5", "5", False, False, "CONFLICT"),
        ("5", "5", False, True, "newer"),
        ("v5", "5", False, False, "INVALID"),
        ("1234567890123456789", "5", False, False, "INVALID"),
        ("2026-01-02T00:00:00Z", "2026-01-01T23:00:00-02:00", False, False, "STALE"),
        ("2026-01-02T00:00:00Z", "2026-01-01T00:00:00Z", False, False, "newer"),
        ("2026-01-02T00:00:00Z", "7", False, False, "INVALID"),
    ],
)
def test_order_rule(spark, new, old, same, rejected, want):
    df = spark.createDataFrame([(new, old)], "n string, o string").select(rules.version(F.col("n")).alias("n"), rules.version(F.col("o")).alias("o"))
    assert df.select(rules.order_rule(F.col("n"), F.col("o"), F.lit(same), F.lit(rejected))).first()[0] == want


def test_first_failure_is_the_first(spark):
    assert one(spark, rules.first_failure((F.lit(False), "a"), (F.lit(True), "b"), (F.lit(True), "c")))[0] == "b"
    assert one(spark, rules.first_failure((F.lit(False), "a")))[0] is None


def test_token_bucket_burst_refill_and_cap(spark):
    def run(requests, capacity=3.0, a_minute=60.0):
        rs = F.array(*[F.struct(F.lit(float(at)).alias("at"), F.lit(float(n)).alias("n")) for at, n in requests])
        return one(spark, rules.token_bucket(rs, capacity, a_minute))[0]

    burst = run([(0, 1), (0, 1), (0, 1), (0, 1)])
    assert (burst["granted"], burst["refused"], burst["tokens"]) == (3, 1, 0.0)
    assert run([(0, 3), (1, 1), (1, 1)])["granted"] == 2
    assert run([(0, 3), (1000, 3), (1000, 1)])["refused"] == 1  # the cap holds
    assert one(spark, rules.wait_seconds(F.lit(10), F.lit(9.9)))[0] == 1


def test_backoff_outcome_attention(spark):
    assert [one(spark, rules.backoff_seconds(F.lit(n)))[0] for n in (0, 3, 6, 100)] == [1, 8, 60, 60]
    assert [one(spark, rules.outcome(F.lit(a), F.lit(b)))[0] for a, b in ((True, None), (False, "source"), (False, "service"))] == ["pending", "rejected", "failed"]
    assert one(spark, rules.attention(F.lit(True), F.lit(True), F.lit(True), F.lit(True)))[0] == ["rejected", "stalled"]
    assert one(spark, rules.attention(F.lit(False), F.lit(True), F.lit(False), F.lit(True)))[0] == ["failed"]


def test_section_rules(spark):
    assert [one(spark, t.section_target(F.lit(n)))[0] for n in (0, 499, 500, 1500, 1501, 12001, 99999)] == [0, 0, 1, 1, 2, 8, 8]
    assert [one(spark, t.overview_target(F.lit(n)))[0] for n in (0, 44000, 52000, 60000, 999999)] == [5, 6, 6, 8, 15]  # halves to even
    assert [one(spark, t.skip_reason(F.lit(h), F.lit(b)))[0] for h, b in (("5. References", "x"), ("IV. Acknowledgements.", "x"), ("Results", " "), ("Results", "x"))] == ["REFERENCES", "ACKNOWLEDGEMENTS", "EMPTY", None]
    sizes = F.array(*[F.lit(n).cast("long") for n in (3000, 6000, 1000, 9000, 8000, 0)])
    assert one(spark, t.pack_chunks(sizes))[0] == [1, 2, 2, 3, 4, 4]
    assert [one(spark, t.is_sentence(F.lit(s)))[0] for s in ("This is one.", "two words", "1 2 3", "我们是", "")] == [True, False, False, True, False]
    assert [one(spark, t.is_identifier(F.lit(s)))[0] for s in ("a_b", "a-b.c/d", "a", "_a", "a b_c", "é_a")] == [True, True, False, False, False, False]


def test_codecs(spark):
    r = one(spark, position(F.lit(255), F.lit(16)), *decode_position(position(F.lit(1 << 60), F.lit(7))))
    assert tuple(r) == ("00000000000000ff0000000000000010", 1 << 60, 7)
    assert one(spark, percent_encoded(F.lit("a b*c~é/")))[0] == "a%20b%2Ac~%C3%A9%2F"
    assert [one(spark, bucket_and_key(F.lit(u))[2])[0] for u in ("s3://b/k/x", "s3://b", "http://b/k", "s3://b/k?q")] == [True, False, False, False]
    assert one(spark, html_escaped(F.lit('<a & "b">')))[0] == "&lt;a &amp; &quot;b&quot;&gt;"


def test_scores(spark):
    low, high = one(spark, *wilson(F.lit(0), F.lit(10)))
    assert low == pytest.approx(0, abs=1e-9) and high == pytest.approx(0.27754, abs=1e-4)
    assert one(spark, wilson(F.lit(0), F.lit(0))[0])[0] is None
    assert one(spark, platt(F.lit(0.5), 2.0, 0.0))[0] == pytest.approx(0.5) and 0 < one(spark, platt(F.lit(1.0), 1.0, 0.0))[0] < 1
    xs = F.array(*[F.lit(float(v)) for v in (4, 1, 3, 2)])
    assert [one(spark, nearest_rank(xs, q, r))[0] for q, r in ((0.5, "index"), (0.5, "ceil"), (0.5, "before"), (0.5, "upper"))] == [3, 2, 2, 3]


def test_formula_and_code_folding():
    assert udfs.formula_symbols("2 × 3 ≤ 7") == udfs.latex_symbols(r"2 \times 3 \leq 7 \tag{4}") == sorted(["2", "*", "3", "<=", "7"])
    assert udfs.latex_symbols(r"\alpha + \frac{1}{2}") == ["+", "1", "2"]
    assert udfs.styled_capitals("𝔸 and 𝒞 and B") == ["A", "C"]
    g = [{"x": x * 6.0, "y": y * 12.0, "w": 6.0, "h": 9.0, "c": c} for y, line in enumerate(["if a:", "    b = 1"]) for x, c in enumerate(line) if c != " "]
    assert udfs.code_lines(g[::-1]) == "if a:\n    b = 1"
    assert udfs.code_lines([]) == ""
