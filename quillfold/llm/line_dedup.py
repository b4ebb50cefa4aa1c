"""Line dedup by a log-template tree, in DataFrame functions only.

A line is parsed to a leaf of fixed depth: its number of tokens (what stands between white space), then its first LEAD
tokens, tokens with a digit standing as a wildcard. In leaves that recur across documents, each place's commonest token
is the template's if half of the leaf's lines have it (over half, if min_docs is 2), else the place is a variable field.
Lines that do not fit their leaf's template are parsed one token deeper, and each such group has a template of its own.
A line recurs if its masked text is the masked text of lines of `min_docs` documents, or if it agrees with its group's
template in `alike` of its places and lines of `min_docs` documents do. Either needs CONSTANT constant tokens, and half
of all, that are equal; other lines, as rows of numbers, recur only as they are. Recurring lines are dropped from all
documents but the first (smallest doc_id) that has them.

Lines of under `min_tokens` tokens, unless they have twice as many letters of scripts that are written without spaces,
say little: those of one token are never dropped, and those of more only if `short_docs` documents have the very line.
The query and the pipeline take min_docs = 2. Lines are joined again as they were.

Cases: null text stays null; a null doc_id is one document, before all others; rows of one doc_id are one document
and lose the same lines; a line of any length is one line; ties of commonest tokens go to the smaller; an empty table
gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfold.llm.common import forget, stored

LEAD = 3
WILD = "<*>"
#: A masked text or template tells lines equal if so many of its tokens, and half of them, are constant.
CONSTANT = 3
VARIABLE = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
#: White space that stands between tokens as U+0020 does; a line has no line feed.
OTHER_SPACE = "\t\x0b\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The first bytes, in UTF-8, of those of them that are not ASCII.
LEAD_BYTES = sorted({c.encode()[:1] for c in OTHER_SPACE if not c.isascii()})
#: Letters of scripts that are written without spaces.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
#: All of them lie here, and few letters of other scripts do.
HIGH = "[\u0e00-\U0010ffff]"
#: How the query and the pipeline call it: what two documents share recurs.
SHARED = {"min_docs": 2}
#: Rows of 40 bytes at most up to which a side is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 100_000
#: Bytes of templates up to which they are broadcast.
BROADCAST_BYTES = 4_000_000
FIRST = -(1 << 63)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def parsed(docs: DataFrame, min_tokens: int, min_docs: int = 2, short_docs: int = 20) -> DataFrame:
    """One row per distinct line of a document: did, line (hash of the line), masked (the masked text's hash), text
    (masked, if it tells lines equal), leaf, need (the documents that make the very text recur; null: it never does).

    The leaf is found without cutting the line into tokens, and no line meets a long class of characters before
    searches for single bytes have found that it may have one.
    """
    did = F.coalesce(docs["doc_id"].cast("long"), F.lit(FIRST))
    lines = docs.select(did.alias("did"), F.explode(F.array_distinct(F.split(docs["text"], "\n", -1))).alias("raw"))
    raw, wide = F.col("raw"), F.octet_length("raw") > F.length("raw")
    other = _any([raw.contains(c) for c in OTHER_SPACE if c.isascii()]) | (wide & _any([F.contains(raw.cast("binary"), F.lit(b)) for b in LEAD_BYTES]))
    spaced = F.when(other, F.translate("raw", OTHER_SPACE, " " * len(OTHER_SPACE))).otherwise(raw)
    plain = F.when(raw.rlike("[0-9]"), F.regexp_replace(spaced, VARIABLE, WILD)).otherwise(spaced)
    masked = lines.select("did", F.xxhash64("raw").alias("line"), F.trim(plain).alias("text"), F.trim("raw").alias("plain"))
    spaces = F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" ")))
    # each such letter has three bytes or more, so few lines come to the pattern
    unspaced = (F.octet_length("plain") - F.length("plain") >= 4 * min_tokens) & F.col("plain").rlike(HIGH) & F.col("plain").rlike(f"^(?:[^{UNSPACED}]*+[{UNSPACED}]){{{2 * min_tokens}}}")
    counted = masked.select("*", (spaces + 1).alias("n"), unspaced.alias("unspaced")).withColumn("short", (F.col("n") < min_tokens) & ~F.col("unspaced"))
    # a text of few constant tokens says little of the line: then only the line itself recurs
    wild = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit(WILD)))) / len(WILD)
    rigid = ~F.col("short") & (~F.col("text").contains(WILD) | (F.col("n") - wild >= F.greatest(F.lit(CONSTANT), F.col("n") / 2)))
    masked_ = F.when(rigid, F.xxhash64("text")).otherwise(F.xxhash64(F.lit(1), "plain"))
    leaf = F.when(F.col("short"), F.xxhash64(F.lit(2), "plain")).otherwise(F.xxhash64("n", F.substring_index("text", " ", LEAD)))
    # a filter here would have every line parsed twice
    need = F.when((F.col("n") == 1) & ~F.col("unspaced"), None).when(F.col("short"), max(min_docs, short_docs)).otherwise(min_docs)
    return counted.select("did", "line", masked_.alias("masked"), F.when(rigid, F.col("text")).alias("text"), leaf.alias("leaf"), need.alias("need"))


def _bounded(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(side) if side.count() <= rows else side


def _fitting(distinct: DataFrame, group: str, min_docs: int, alike: float) -> DataFrame:
    """group, masked: the texts (leaf, masked, n, tokens) that fit their group's template."""
    places = distinct.select(group, "n", F.posexplode("tokens").alias("at", "token")).groupBy(group, "at", "token").agg(F.sum("n").alias("n"))
    commonest = places.groupBy(group, "at").agg(F.max(F.struct("n", F.struct(F.col("token")))).alias("top"), F.sum("n").alias("all"))
    # in groups of two documents, half of the lines may be one line
    common = 2 * F.col("top.n") >= F.col("all") if min_docs > 2 else 2 * F.col("top.n") > F.col("all")
    token = F.when(common, F.col("top.col2.token"))
    # an array has one group's places, as many as one line's tokens
    templates = stored(commonest.select(group, "at", token.alias("token")).groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda p: p["token"]).alias("template")), "leaf-templates")
    size = templates.agg(F.coalesce(F.sum(F.size("template") * 8 + F.octet_length(F.array_join("template", ""))), F.lit(0))).first()[0]
    agreed = F.filter(F.zip_with("tokens", "template", lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())
    constant = F.size(F.filter(agreed, lambda x: x != WILD)) >= F.greatest(F.lit(CONSTANT), F.size("tokens") / 2)
    return distinct.join(F.broadcast(templates) if size <= BROADCAST_BYTES else templates, group).where((F.size(agreed) >= alike * F.size("tokens")) & constant)


def recurring(docs: DataFrame, min_docs: int = 3, alike: float = 0.7, min_tokens: int = 5, short_docs: int = 20) -> DataFrame:
    """did and lines: the hashes of each document's lines that recur from an earlier document."""
    table = stored(parsed(docs, min_tokens, min_docs, short_docs), "lines")
    all_lines = table.where("need is not null")
    lines = all_lines.select("did", "line", "masked", "leaf", "need")
    leaves = stored(lines.groupBy("leaf", "did").agg(F.max("need").alias("need")).groupBy("leaf").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("leaf"), "leaves")
    again = stored(lines.join(_bounded(leaves), "leaf", "left_semi"), "again")
    exact = stored(again.groupBy("masked", "did").agg(F.max("need").alias("need")).groupBy("masked").agg(F.count("*").alias("n"), F.max("need").alias("need"), F.min("did").alias("first")).where("n >= need").select("masked", "first"), "exact")
    by_text = again.join(_bounded(exact), "masked").where(F.col("did") != F.col("first")).select("did", "line")
    # templates of the recurring leaves of several texts (one text alone recurs as it is), then of what does not fit them
    several = stored(again.groupBy("leaf").agg(F.min("masked").alias("lo"), F.max("masked").alias("hi")).where("lo <> hi").select("leaf"), "several")
    held = all_lines.where("text is not null").select("leaf", "masked", "text").join(_bounded(several), "leaf", "left_semi")
    distinct = stored(held.groupBy("leaf", "masked", "text").agg(F.count("*").alias("n")).select("leaf", "masked", "n", F.split("text", " ").alias("tokens")), "templates")
    forget(table, several)
    fits = stored(_fitting(distinct, "leaf", min_docs, alike).select("leaf", "masked", F.col("leaf").alias("group")), "fits")
    rest = distinct.join(_bounded(fits.select("leaf", "masked")), ["leaf", "masked"], "left_anti").withColumn("group", F.xxhash64("leaf", F.get("tokens", F.lit(LEAD))))
    deeper = _fitting(stored(rest, "deeper"), "group", min_docs, alike).select("leaf", "masked", "group")
    fitting = stored(fits.union(deeper), "fitting")
    forget(distinct, fits)
    of_leaf = again.join(_bounded(fitting), ["leaf", "masked"])
    shared = stored(of_leaf.select("group", "did").distinct().groupBy("group").agg(F.count("*").alias("n"), F.min("did").alias("first")).where(F.col("n") >= min_docs).drop("n"), "shared")
    by_template = of_leaf.join(_bounded(shared), "group").where(F.col("did") != F.col("first")).select("did", "line")
    return by_text.union(by_template).groupBy("did").agg(F.collect_set("line").alias("lines"))


def dedup(docs: DataFrame, min_docs: int = 3, alike: float = 0.7, min_tokens: int = 5, short_docs: int = 20) -> tuple[DataFrame, Column, Column]:
    """docs joined with what recurs; the text that is left; the number of lines dropped."""
    gone = recurring(docs, min_docs, alike, min_tokens, short_docs).select(F.col("did").alias("_did"), F.col("lines").alias("_lines"))
    joined = docs.join(gone, F.coalesce(docs["doc_id"].cast("long"), F.lit(FIRST)) == gone["_did"], "left")
    lines = F.split(docs["text"], "\n", -1)
    kept = F.filter(lines, lambda x: ~F.array_contains(gone["_lines"], F.xxhash64(x)))
    some = gone["_lines"].isNotNull() & docs["text"].isNotNull()
    text = F.when(some, F.array_join(kept, "\n")).otherwise(docs["text"])
    return joined, text, F.when(some, F.size(lines) - F.size(kept)).otherwise(F.lit(0)).cast("long")


def strip(docs: DataFrame, **how) -> DataFrame:
    """The columns of docs, with text (and n_chars, if there) without recurring lines."""
    joined, text, _ = dedup(docs, **how)
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None}
    return joined.select(*[new[c] if c in new else docs[c] for c in docs.columns])


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_dropped and text."""
    joined, text, dropped = dedup(docs, **how)
    lines = F.when(docs["text"].isNull(), F.lit(0)).otherwise(F.size(F.split(docs["text"], "\n", -1))).cast("long")
    return joined.select(docs["doc_id"], lines.alias("n_lines"), dropped.alias("n_dropped"), text.alias("text"))
