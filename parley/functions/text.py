"""Text column functions (all built-in Spark expressions, so they stay inside whole-stage codegen)."""

from __future__ import annotations

import unicodedata

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import SPACE_CLASS

ColumnOrName = Column | str

def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (``trim`` only drops spaces)."""
    return F.regexp_replace(col(c), f"(?U)^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def normalize_ws(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return F.trim(F.regexp_replace(col(c), f"(?U)[{SPACE_CLASS}]+", " "))


def has_non_space(c: ColumnOrName) -> Column:
    """True when ``normalize_ws(c) != ''`` (stops at the first non-space character)."""
    return col(c).rlike(f"(?U)[^{SPACE_CLASS}]")


def blank_or_broken(c: ColumnOrName) -> Column:
    """Text that is empty, or only ``.``/``..``/``...`` after stripping (kept, only flagged)."""
    s = py_strip(c)
    return s.isin("", ".", "..", "...")


def contains_any(text_lower: Column, patterns: Iterable[str]) -> Column:
    """Q1: any literal substring occurs in the (already lower-cased) text.

    An OR of ``contains`` literals: each is a codegen'd ``UTF8String.contains``.
    """
    pats = [p.lower() for p in dict.fromkeys(patterns)]
    if not pats:
        return F.lit(False)
    out = None
    for p in pats:
        term = text_lower.contains(p)
        out = term if out is None else (out | term)
    return out


def py_float_str(c: ColumnOrName) -> Column:
    """Python ``str(float)`` for ordinary magnitudes (Spark prints 1.0E7 from 1e7 on; call times stay below)."""
    return col(c).cast("double").cast("string")


def fmt_segment(start: ColumnOrName, end: ColumnOrName, speaker: ColumnOrName, text: ColumnOrName) -> Column:
    """Q4: evidence text ``[start-end] speaker: text``."""
    return F.concat(F.lit("["), py_float_str(start), F.lit("-"), py_float_str(end), F.lit("] "),
                    col(speaker), F.lit(": "), col(text))


def first_non_blank(columns: Sequence[ColumnOrName], required: bool = False) -> Column:
    """First value that is a non-blank string, in the given column order. A row without one gives null, or ends the
    job with the names of the columns looked at where ``required``."""
    found = [F.when(py_strip(col(c)) != "", col(c)) for c in columns]
    if required:
        found.append(F.raise_error(F.lit(f"no text in any of the columns {', '.join(map(str, columns))}")).cast("string"))
    return F.coalesce(*found)


def sentence_pieces(text_norm: Column, enders: str = ".!?") -> Column:
    """Split normalised text after a sentence end followed by whitespace."""
    cls = "".join("\\" + ch if ch in ".?!" else ch for ch in enders)
    return F.split(text_norm, f"(?<=[{cls}]) ")


def digits_to_double(c: Column) -> Column:
    """A run of decimal digits of any script (with ``.``) as a double; anything else is NULL."""
    zeros = [cp for cp in range(0x110000) if unicodedata.decimal(chr(cp), None) == 0]
    foreign = "".join(chr(z + d) for z in zeros if z != 48 for d in range(10))
    return F.translate(c, foreign, "0123456789" * (len(foreign) // 10)).try_cast("double")
