"""PII detection, redaction and span columns (D1-D9, regex part of G4). Built-in regex expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import regex as rx
from .text import col

DETECTORS: dict[str, str] = {
    "card": rx.J_CARD,
    "fin": rx.J_FIN_CALL,
    "fin7": rx.J_FIN_7,
    "fin_digit_first": rx.J_FIN_DIGIT_FIRST,
    "cvv": rx.J_CVV,
    "phone": rx.J_PHONE_LOOSE,
    "phone_strict": rx.J_PHONE_STRICT,
    "phone_nanp": rx.J_PHONE_NANP,
    "email": rx.J_EMAIL,
    "num34": rx.J_NUM_3_4,
}

NEEDS_DIGIT = {"card", "fin", "fin_digit_first", "phone", "phone_strict", "phone_nanp", "num34"}

# D6 variants: which detectors make a text "look like PII".
LOOKS_LIKE = {
    "corpus": ["email", "phone", "card", "fin7"],
    "explore": ["fin_digit_first", "phone_strict", "card"],
}


def matches(text, kind: str, group: int = 0) -> Column:
    """All matches of one detector (D1-D5); ``fin`` returns the code without its ``FIN kod`` prefix."""
    g = 1 if kind == "fin" and group == 0 else group
    return F.regexp_extract_all(col(text), F.lit(DETECTORS[kind]), g)


def count(text, kind: str) -> Column:
    return F.size(matches(text, kind))


def has(text, kind: str) -> Column:
    return col(text).rlike(DETECTORS[kind])


def looks_like(text, variant: str = "corpus") -> Column:
    """OR of the detectors of a variant.

    When every detector of the variant needs a digit, a cheap ``[0-9]`` test goes first so that
    most texts skip the costly patterns (the 7-character FIN form can be all letters: no prefilter).
    """
    t = col(text)
    hit = None
    for k in LOOKS_LIKE[variant]:
        term = t.rlike(DETECTORS[k])
        hit = term if hit is None else (hit | term)
    if all(k in NEEDS_DIGIT for k in LOOKS_LIKE[variant]):
        return t.rlike("[0-9]") & hit
    return hit


def find_pii(text) -> Column:
    """Ordered findings ``array<struct<kind,value>>``: card numbers, then FIN codes (>= 7 chars), then CVV mentions."""
    t = col(text)

    def tag(kind: str, arr: Column) -> Column:
        return F.transform(arr, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    fins = F.filter(F.regexp_extract_all(t, F.lit(rx.J_FIN_CALL), 1), lambda v: F.length(v) >= 7)
    return F.concat(tag("card_number", F.regexp_extract_all(t, F.lit(rx.J_CARD), 0)),
                    tag("fin_code", fins),
                    tag("cvv_mention", F.regexp_extract_all(t, F.lit(rx.J_CVV), 0)))


def contains_pii(text) -> Column:
    """``find_pii`` is non-empty (a FIN group is always >= 7 characters, so a match suffices)."""
    t = col(text)
    return t.rlike(rx.J_CARD) | t.rlike(rx.J_FIN_CALL) | t.rlike(rx.J_CVV)


def redact(text) -> Column:
    """Card -> [CARD_NUMBER], then 3-4 digit words -> [NUM], then FIN -> [FIN_CODE], in that order."""
    t = F.regexp_replace(col(text), rx.J_CARD, "[CARD_NUMBER]")
    t = F.regexp_replace(t, rx.J_NUM_3_4, "[NUM]")
    return F.regexp_replace(t, rx.J_FIN_REDACT, "[FIN_CODE]")
