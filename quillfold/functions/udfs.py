"""Arrow-batched functions for what Spark has no built-in for: Unicode normalisation, formula symbols, code layout."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# How formula text is folded.
SIGNS = {"−": "-", "–": "-", "∗": "*", "⋅": "*", "×": "*", "÷": "/", "≤": "<=", "≥": ">=", "≠": "!="}
COMMANDS = {"times": "*", "cdot": "*", "div": "/", "leq": "<=", "le": "<=", "geq": ">=", "ge": ">=", "neq": "!=", "ne": "!=", "pm": "±", "frac": "", "left": "", "right": ""}
STYLES = ("mathcal", "mathbb", "mathfrak", "mathscr")
# end of fixed values

_COMMAND = re.compile(r"\\([A-Za-z]+)")
_STYLED = re.compile(r"\\(" + "|".join(STYLES) + r")\s*\{?\s*([A-Z])\s*\}?")
_SYMBOL = re.compile(r"<=|>=|!=|[0-9+\-*/=<>±()]")


def nfkc_text(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKC", text)


def formula_symbols(text: str | None) -> list[str] | None:
    """The sorted multiset of digits and operators, signs folded to ASCII."""
    if text is None:
        return None
    plain = "".join(SIGNS.get(c, c) for c in unicodedata.normalize("NFKC", text))
    return sorted(_SYMBOL.findall(plain))


def latex_symbols(text: str | None) -> list[str] | None:
    """The same of LaTeX source: tags go, operator commands are folded, other commands dropped."""
    if text is None:
        return None
    plain = re.sub(r"\\tag\s*\{[^}]*\}", "", text)
    plain = _STYLED.sub(lambda m: m[2], plain)
    plain = _COMMAND.sub(lambda m: COMMANDS.get(m[1], " "), plain)
    return formula_symbols(plain)


def styled_capitals(text: str | None) -> list[str] | None:
    """Capitals in a mathematical alphabet, by the last word of their Unicode names."""
    if text is None:
        return None
    names = (unicodedata.name(c, "") for c in text)
    return sorted(n.rsplit(" ", 1)[-1] for n in names if n.startswith(("MATHEMATICAL ", "SCRIPT CAPITAL", "DOUBLE-STRUCK CAPITAL", "BLACK-LETTER CAPITAL")) and " CAPITAL " in n)


def code_lines(glyphs: list[dict]) -> str:
    """Text of a code box from glyphs (x, y, w, h, c): rows by centre, indents and gaps in units of the advance."""
    rows: list[list[dict]] = []
    for g in sorted(glyphs, key=lambda g: (g["y"] + g["h"] / 2, g["x"])):
        if rows:
            last = rows[-1][-1]
            if abs(g["y"] + g["h"] / 2 - last["y"] - last["h"] / 2) <= 0.3 * min(g["h"], last["h"]):
                rows[-1].append(g)
                continue
        rows.append([g])
    for r in rows:
        r.sort(key=lambda g: g["x"])
    steps = sorted(b["x"] - a["x"] for r in rows for a, b in zip(r, r[1:], strict=False) if b["x"] > a["x"])
    widths = sorted(g["w"] for g in glyphs if g["w"] > 0)
    # the advance of a fixed pitch: no glyph is wider, and gaps only add to steps
    unit = min([*widths[len(widths) // 2 :][:1], *steps[len(steps) // 2 :][:1]], default=1.0)
    left = min((r[0]["x"] for r in rows), default=0.0)
    out = []
    for r in rows:
        line = " " * round((r[0]["x"] - left) / unit) + r[0]["c"]
        for a, b in zip(r, r[1:], strict=False):
            line += " " * max(0, round((b["x"] - a["x"]) / unit) - 1) + b["c"]
        out.append(line.rstrip())
    return "\n".join(out)


def same_multiset(a: list[str], b: list[str]) -> bool:
    return Counter(a) == Counter(b)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(nfkc_text)


@F.pandas_udf(ArrayType(StringType()))
def symbols(s: pd.Series) -> pd.Series:
    return s.map(formula_symbols)


@F.pandas_udf(ArrayType(StringType()))
def latex(s: pd.Series) -> pd.Series:
    return s.map(latex_symbols)


@F.pandas_udf(ArrayType(StringType()))
def capitals(s: pd.Series) -> pd.Series:
    return s.map(styled_capitals)


@F.pandas_udf(StringType())
def code_text(s: pd.Series) -> pd.Series:
    return s.map(lambda v: code_lines([dict(g) for g in v]) if v is not None else None)
