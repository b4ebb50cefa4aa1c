"""Secret scans by pattern and by randomness, in DataFrame functions only.

Three patterns give the base spans. Besides, every long token of an encoding's alphabet is tested for randomness:
chi-squared uniformity over the symbols (hex) or symbol classes (base32, base64), the runs of symbols above and below
the alphabet's middle, and lag-one serial correlation. The smallest of the three p-values, corrected for three tests,
is the token's. A small p-value says that the token is no random string. Which tokens are told apart from random is
settled by the Benjamini-Hochberg rule within strata of like length, over all tokens of the corpus (from a histogram
of p-values), so that long and short tokens are each held to the rate; tokens that are not told apart are spans of
kind `random`.

Cases: null text is empty; texts and tokens of any length are read whole; positions are code points; repeated rows
each give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfold.llm.common import let, stored, text_of

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# end of fixed values
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
RATE = 0.05
P_BINS = 320
BINS_A_DECADE = 20
BLOCK = 64

SPAN = "array<struct<start: int, end: int, size: int>>"


def _running(sizes: Column) -> Column:
    """The sum of the elements before each one, by blocks, so that arrays of many matches stay cheap."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def with_blocks(s: Column, blocks: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.size(blocks) - 1), lambda b: total(F.slice(blocks, F.lit(1), b)))
        return let(before, lambda p: F.transform(s, lambda _, i: F.get(p, F.floor(i / BLOCK).cast("int")) + total(F.slice(s, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))

    def of(s: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(s, b * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, lambda b: with_blocks(s, b))

    return let(sizes, of)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches in code points: start, end and the group's size."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)

    def spans(m: Column) -> Column:
        starts = _running(F.transform(m["hits"], lambda h, i: h + F.get(m["gaps"], i)))
        return let(starts, lambda s: F.transform(m["hits"], lambda h, i: F.struct((F.get(s, i) + F.get(m["gaps"], i)).alias("start"), (F.get(s, i) + F.get(m["gaps"], i) + h).alias("end"), F.get(m["sizes"], i).alias("size"))))

    found = let(F.struct(gaps.alias("gaps"), hits.alias("hits"), sizes.alias("sizes")), spans)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def upper_tail(z: Column) -> Column:
    """P(N(0, 1) > z), by a logistic curve (error under 0.0002)."""
    x = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(1.5976 * x + 0.07056 * x * x * x))


def chi_squared_p(stat: Column, freedom: Column) -> Column:
    """Upper tail of the chi-squared distribution (Wilson and Hilferty)."""
    k = 2 / (9 * freedom)
    return upper_tail((F.pow(stat / freedom, F.lit(1 / 3)) - (1 - k)) / F.sqrt(k))


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * upper_tail(F.abs(z)))


def randomness_p(token: Column) -> Column:
    """The p-value of a token under the hypothesis that its symbols are random in its inferred encoding."""
    body = F.regexp_replace(token, "=+$", "")
    alphabet = (
        F.when(body.rlike("^[0-9a-f]+$"), F.lit("0123456789abcdef"))
        .when(body.rlike("^[0-9A-F]+$"), F.lit("0123456789ABCDEF"))
        .when(body.rlike("^[A-Z2-7]+$"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
        .otherwise(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    )

    def tests(t: Column) -> Column:
        values = F.transform(F.split(F.translate(t["body"], "-_", "+/"), ""), lambda c: F.instr(t["alphabet"], c) - 1)
        return let(values, lambda v: battery(v, F.length(t["alphabet"])))

    def battery(v: Column, m: Column) -> Column:
        n = F.size(v).cast("double")

        def within(lo: int, hi: int) -> Column:
            return F.size(F.filter(v, lambda x: (x >= lo) & (x < hi)))

        def chi(parts: list[tuple[int, int]], size: float) -> Column:
            stat = reduce(lambda a, b: a + b, [F.pow(within(lo, hi) - n * (hi - lo) / size, F.lit(2)) / (n * (hi - lo) / size) for lo, hi in parts])
            return chi_squared_p(stat, F.lit(float(len(parts) - 1)))

        uniform = F.when(m == 16, chi([(i, i + 1) for i in range(16)], 16.0)).when(m == 32, chi([(0, 13), (13, 26), (26, 32)], 32.0)).otherwise(chi([(0, 26), (26, 52), (52, 62), (62, 64)], 64.0))
        start = F.struct(F.lit(None).cast("boolean").alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"))
        run = F.aggregate(
            v,
            start,
            lambda a, x: F.struct((2 * x >= m).alias("last"), (a["runs"] + F.when(a["last"].eqNullSafe(2 * x >= m), 0.0).otherwise(1.0)).alias("runs"), (a["high"] + F.when(2 * x >= m, 1.0).otherwise(0.0)).alias("high")),
        )

        def runs_p(r: Column) -> Column:
            mean = 2 * r["high"] * (n - r["high"]) / n + 1
            spread = (mean - 1) * (mean - 2) / (n - 1)
            return F.when(spread > 0, two_sided((r["runs"] - mean) / F.sqrt(spread))).otherwise(F.lit(0.0))

        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n

        def serial_p(mid: Column) -> Column:
            zero = F.struct(F.lit(0.0).alias("last"), F.lit(0.0).alias("both"), F.lit(0.0).alias("square"))
            acc = F.aggregate(v, zero, lambda a, x: F.struct((x - mid).alias("last"), (a["both"] + a["last"] * (x - mid)).alias("both"), (a["square"] + (x - mid) * (x - mid)).alias("square")))
            return let(acc, lambda a: F.when(a["square"] > 0, two_sided(a["both"] / a["square"] * F.sqrt(n))).otherwise(F.lit(0.0)))

        return F.least(F.lit(1.0), 3 * F.least(uniform, let(run, runs_p), let(mean, serial_p)))

    return let(F.struct(body.alias("body"), alphabet.alias("alphabet")), tests)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the base spans assign, access and hex, and tokens (start, end, p, stratum) to be judged."""
    text = text_of(docs)
    found = docs.select(
        "doc_id",
        F.filter(matches(text, ASSIGN, 2), lambda s: s["size"] >= MIN_ASSIGN).alias("assign"),
        F.filter(matches(text, ACCESS), lambda s: s["size"] >= MIN_ACCESS).alias("access"),
        # the runs of fewer digits go all the same, and whole runs are matched either way
        matches(text, HEX.replace("+", "{%d,}" % MIN_HEX)).alias("hex"),
        F.transform(
            matches(text, TOKEN),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), randomness_p(F.substring(text, s["start"] + 1, s["size"])).alias("p"), F.floor(F.log2(s["size"].cast("double"))).cast("int").alias("stratum")),
        ).alias("tokens"),
    )
    return stored(found, "secrets")


def thresholds(found: DataFrame, rate: float = RATE) -> DataFrame:
    """One row: a map from stratum to the p-value up to which its tokens are told apart from random strings."""
    p = found.select(F.explode("tokens").alias("t")).select("t.stratum", F.least(F.lit(P_BINS - 1), F.floor(-F.log10(F.greatest("t.p", F.lit(1e-300))) * BINS_A_DECADE)).cast("int").alias("bin"))
    counts = p.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    by = Window.partitionBy("stratum")
    upto = counts.select("stratum", F.pow(F.lit(10.0), -F.col("bin") / BINS_A_DECADE).alias("edge"), F.sum("n").over(by.orderBy(F.desc("bin"))).alias("below"), F.sum("n").over(by).alias("all"))
    cut = upto.where(F.col("edge") <= rate * F.col("below") / F.col("all")).groupBy("stratum").agg(F.max("edge").alias("cut"))
    return cut.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cut"))).alias("cuts"))


def find(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id and, by kind, arrays of spans: assign, access, hex, random."""
    found = scan(docs)
    judged = found.join(F.broadcast(thresholds(found, rate)))  # one row of at most 32 strata
    kept = F.filter("tokens", lambda t: t["p"] > F.coalesce(F.try_element_at("cuts", t["stratum"]), F.lit(0.0)))
    return judged.select("doc_id", "assign", "access", "hex", kept.alias("random"))


def listed(*kinds: str) -> Column:
    """kind:start:end of the kinds' spans by start, then kind as listed, comma-joined."""

    def numbered(kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), number, s["end"].alias("end")))

    rows = F.concat(*map(numbered, kinds))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(rows), lambda r: F.concat_ws(":", F.get(names, r["kind"]), r["start"].cast("string"), r["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    sizes = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *sizes, F.sha2(listed(*KINDS[:3]), 256).alias("base_sha256"), listed(*KINDS).alias("spans"))
