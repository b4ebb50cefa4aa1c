"""Host-level quality rules, in DataFrame functions only.

Per document: word, symbol and line counts and four rules: too few words, too many words in repeated windows (these two
are the base rules), symbols of over a tenth of the words, and duplicate lines of over three tenths of all lines. Each
rule's failures are summed by host (the source), the hosts' failure rates are shrunk towards the corpus by a beta prior
fitted to them by moments, rule by rule, and a host over the limit in any rule loses all its documents. The limit is a
half: a host goes if most of its documents break the same rule. A document goes by itself by the base rules alone.

Cases: null text has no words and fails; a null source is a host of its own; texts of any length are read whole;
repeated rows each give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import SPACE, let, stored, text_of, words

SYMBOLS = "#*$%&|<>"
RULES = ("few_words", "repeats", "symbols", "dup_lines")


def repeated_window_words(w: Column, span: int = 3) -> Column:
    """How many words of the array w lie in a window of span words that w holds twice or more."""

    def marked(keys: Column) -> Column:
        order = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return let(order, lambda s: F.array_sort(F.filter(F.transform(s, lambda x, j: _twin(s, x, j)), lambda p: p.isNotNull())))

    def _twin(s: Column, x: Column, j: Column) -> Column:
        before = (j > 0) & (F.get(s, j - 1)["k"] == x["k"])
        after = (j < F.size(s) - 1) & (F.get(s, j + 1)["k"] == x["k"])
        return F.when(before | after, x["i"])

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda a, k: F.when(k == F.size(p) - 1, F.lit(span)).otherwise(F.least(F.lit(span), F.get(p, k + 1) - a)))
        return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)

    def of_keys(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(let(marked(keys), covered))

    def of_words(v: Column) -> Column:
        n = F.size(v)
        keys = F.transform(F.sequence(F.lit(0), n - span), lambda i: F.xxhash64(*[F.get(v, i + k) for k in range(span)]))
        return F.when(n < span, F.lit(0)).otherwise(let(keys, of_keys))

    return of_words(w)


def line_counts(text: Column) -> Column:
    """n, the lines with a word, and dup, those of them that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return let(lines, lambda v: F.struct(F.size(v).cast("long").alias("n"), (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("dup")))


def document_rules(docs: DataFrame, min_words: int = 50, max_repeat: float = 0.5, max_symbols: int = 10, max_dup_lines: int = 30) -> DataFrame:
    """doc_id, source, the per-document counts, base_failed and the rules' failures (RULES); the last two in percent."""
    text = text_of(docs)
    strip = F.translate(text, SPACE, "")
    counted = docs.select(
        "doc_id",
        docs["source"].cast("string").alias("source"),
        F.length(strip).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        line_counts(text).alias("l"),
        let(words(text), lambda v: F.struct(F.size(v).cast("long").alias("n"), repeated_window_words(v).cast("long").alias("r"))).alias("w"),
    )
    flat = counted.select("doc_id", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"))
    failed = {
        "few_words": F.col("n_words") < min_words,
        "repeats": F.col("n_repeat_words") > max_repeat * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > max_symbols * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > max_dup_lines * F.col("n_lines"),
    }
    return flat.select("*", (failed["few_words"] | failed["repeats"]).alias("base_failed"), *[c.alias(n) for n, c in failed.items()])


def host_rates(rules: DataFrame, max_strength: float = 1000.0) -> DataFrame:
    """host, rule, n_docs, n_failed and rate, shrunk by the rule's empirical beta prior: a row a host and rule."""
    hosts = rules.groupBy(F.col("source").alias("host")).agg(F.count("*").alias("n_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    each = hosts.select("host", "n_docs", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n_failed")) for r in RULES])).alias("x")).select("host", "n_docs", "x.rule", "x.n_failed")
    own = F.col("n_failed") / F.col("n_docs")
    moments = each.groupBy("rule").agg((F.sum("n_failed") / F.sum("n_docs")).alias("mean"), (F.sum(own * own * F.col("n_docs")) / F.sum("n_docs")).alias("square"))
    # beta moments: strength + 1 = mean (1 - mean) / variance
    spread = F.col("square") - F.col("mean") * F.col("mean")
    strength = F.greatest(F.lit(1.0), F.least(F.lit(max_strength), F.coalesce(F.try_divide(F.col("mean") * (1 - F.col("mean")), spread) - 1, F.lit(max_strength))))
    # prior: a row a rule
    prior = moments.select("rule", "mean", strength.alias("strength"))
    shrunk = (F.col("n_failed") + F.col("mean") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    return each.join(F.broadcast(prior), "rule").select("host", "rule", "n_docs", "n_failed", shrunk.alias("rate"))


def host_verdicts(rules: DataFrame, max_rate: float = 0.5, max_strength: float = 1000.0) -> DataFrame:
    """host, host_rate (the worst rule's) and host_kept."""
    return host_rates(rules, max_strength).groupBy("host").agg(F.max("rate").alias("host_rate")).withColumn("host_kept", F.col("host_rate") <= max_rate)


def judge(docs: DataFrame, min_words: int = 50, max_repeat: float = 0.5, max_rate: float = 0.5) -> DataFrame:
    """document_rules with host_rate and kept: not base_failed and of a kept host."""
    rules = stored(document_rules(docs, min_words, max_repeat), "quality")
    hosts = host_verdicts(rules, max_rate)
    out = rules.join(hosts, rules["source"].eqNullSafe(hosts["host"]), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("host_kept"), F.lit(True))
    return out.select(*[rules[c] for c in rules.columns], "host_rate", kept.alias("kept"))
