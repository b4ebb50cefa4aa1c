"""Section and sentence rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section rules.
REFERENCE_HEADINGS = ("references", "bibliography", "works cited", "literature cited", "references and notes", "參考文獻", "参考文献", "參考資料")
ACKNOWLEDGEMENT_STEMS = ("acknowledg", "致謝", "致谢", "誌謝")
MIN_SECTION_CHARS, CHARS_A_SENTENCE, MAX_SENTENCES = 500, 1500, 8
CHARS_AN_OVERVIEW_SENTENCE, MIN_OVERVIEW, MAX_OVERVIEW = 8000, 5, 15
CHUNK_CHARS = 8000
INLINE_BYTES = 16384
# end of fixed values


def heading(text: Column) -> Column:
    """Without leading numbering and closing punctuation, in lower case."""
    plain = F.regexp_replace(text, r"^\s*(?:[0-9]+(?:\.[0-9]+)*|[IVXLC]+|[A-Z])[.):]?\s+", "")
    return F.lower(F.trim(F.regexp_replace(plain, r"[\s.:;,]+$", "")))


def skip_reason(title: Column, body: Column) -> Column:
    name = heading(title)
    thanks = F.lit(False)
    for stem in ACKNOWLEDGEMENT_STEMS:
        thanks = thanks | name.startswith(stem)
    return F.when(F.trim(body) == "", "EMPTY").when(name.isin(*REFERENCE_HEADINGS), "REFERENCES").when(thanks, "ACKNOWLEDGEMENTS")


def section_target(chars: Column) -> Column:
    return F.when(chars < MIN_SECTION_CHARS, 0).otherwise(F.least(F.lit(MAX_SENTENCES), F.ceil(chars / CHARS_A_SENTENCE).cast("int"))).cast("int")


def overview_target(chars: Column) -> Column:
    """Halves round to even."""
    return F.greatest(F.lit(MIN_OVERVIEW), F.least(F.lit(MAX_OVERVIEW), F.bround(chars / CHARS_AN_OVERVIEW_SENTENCE, 0).cast("int")))


def pack_chunks(sizes: Column, limit: int = CHUNK_CHARS) -> Column:
    """The chunk number (from 1) of each of consecutive sizes; a chunk closes before it would pass the limit, nothing is split.

    One fold: the running chunk and its fill travel with the numbers given so far.
    """
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("fill"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, n: Column) -> Column:
        new = (acc["chunk"] == 0) | (acc["fill"] + n > limit)
        chunk = F.when(new, acc["chunk"] + 1).otherwise(acc["chunk"])
        return F.struct(chunk.alias("chunk"), F.when(new, n).otherwise(acc["fill"] + n).cast("long").alias("fill"), F.array_append(acc["out"], chunk).alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def word_units(text: Column) -> Column:
    """Words, where each CJK character is one."""
    return F.size(F.regexp_extract_all(text, F.lit(r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|[^\s\p{IsHan}\p{IsHiragana}\p{IsKatakana}]+)"), F.lit(1)))


def is_sentence(text: Column) -> Column:
    return (word_units(text) >= 3) & text.rlike(r"\p{L}")


def is_identifier(text: Column) -> Column:
    """One ASCII token whose parts are joined by one of _ . / -"""
    return text.rlike(r"^[A-Za-z0-9]+(?:[_./-][A-Za-z0-9]+)+$")
