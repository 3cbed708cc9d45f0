"""Regular-expression dialect helpers and the fixed detector patterns.

The patterns below are written in Python's ``re`` dialect as the behaviour to match. Spark runs
``java.util.regex``: ``\\w \\d \\s \\b`` are ASCII there unless the ``(?U)`` flag is set, so every
pattern handed to Spark goes through :func:`java` which adds ``(?U)`` (and ``i`` for
case-insensitive patterns). Python's ``re.IGNORECASE`` lets ``[A-Z]`` also match ``İ`` (U+0130) and
the Kelvin sign (U+212A); Java's ``(?iU)`` matches neither, so the Java forms spell both out inside
those classes (checked: ``ı`` and ``ſ`` already match in both).

Always pass these as literals: ``RLike``/``RegExpReplace``/``RegExpExtract`` compile a literal
pattern once per task, a pattern column would be recompiled per row.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------------------------
# Detector patterns whose matches must equal the reference's (Python dialect).
# ---------------------------------------------------------------------------------------------
CARD = r"\b(?:\d[ -]*?){13,19}\b"
FIN_CALL = r"\b(?:FIN\s*kodu?m?\s*)?([0-9][A-Z0-9]{6,8})\b"          # case-insensitive, value in group 1
FIN_REDACT = r"\b([0-9][A-Z0-9]{6,8})\b"                            # case-insensitive
CVV = r"\bCVV\b|\bCVC\b"                                            # case-insensitive
NUM_3_4 = r"\b\d{3,4}\b"
EMAIL = r"\b[\w\.-]+@[\w\.-]+\.\w+\b"                               # case-insensitive
PHONE_LOOSE = r"(\+994|0)\s*\d{2}[\s-]*\d{3}[\s-]*\d{2}[\s-]*\d{2}"
FIN_7 = r"\b[A-Z0-9]{7}\b"
FIN_DIGIT_FIRST = r"\b\d{2}[A-Z]{2,3}[A-Z0-9]{4,6}\b"
PHONE_STRICT = r"(\+994\s?\d{2}\s?\d{3}\s?\d{2}\s?\d{2})|(\b0\d{2}\s?\d{3}\s?\d{2}\s?\d{2}\b)"
SILENCE_MARKER = r"\[(\d+)\s*saniyə\s*sük[üu]t\]"                   # case-insensitive, seconds in group 1
TECH_VISIT = r"texnik\s+gələcək|bu\s+gün\s+.*texnik"                # case-insensitive
AMOUNT = r"\b\d+\s*manat\b"
MULTI_STAR = r"\*{4,}"
# ---------------------------------------------------------------------------------------------

# Extra detector offered as a parameter (not in the reference): North-American style numbers
# such as "+1 (743) 555-3824", present in the test tables.
PHONE_NANP = r"\+1\s?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}\b"

# Python ``str`` semantics as Java classes: \w = letters, numbers, underscore; \s = str.isspace().
# With (?U), Java's \s is the Unicode White_Space set; str.isspace() adds \x1C-\x1F. The short
# class form is about twice as fast as spelling the ranges out.
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\s\x1C-\x1F"

_UPPER_CLASS = re.compile(r"A-Z")


def java(pattern: str, ignore_case: bool = False) -> str:
    """Translate a Python-dialect pattern to the equivalent ``java.util.regex`` pattern."""
    p = pattern
    if ignore_case:
        # Python re.I matches U+0130 and U+212A against [A-Z]; Java (?iU) does not.
        p = _UPPER_CLASS.sub("A-Z\u0130\u212a", p)
        return "(?iU)" + p
    return "(?U)" + p


# Java forms used by the operators (built once, passed as literals).
J_CARD = java(CARD)
J_FIN_CALL = java(FIN_CALL, ignore_case=True)
J_FIN_REDACT = java(FIN_REDACT, ignore_case=True)
J_CVV = java(CVV, ignore_case=True)
J_NUM_3_4 = java(NUM_3_4)
J_EMAIL = java(EMAIL, ignore_case=True)
J_PHONE_LOOSE = java(PHONE_LOOSE)
J_FIN_7 = java(FIN_7)
J_FIN_DIGIT_FIRST = java(FIN_DIGIT_FIRST)
J_PHONE_STRICT = java(PHONE_STRICT)
J_PHONE_NANP = java(PHONE_NANP)
J_SILENCE_MARKER = java(SILENCE_MARKER, ignore_case=True)
J_TECH_VISIT = java(TECH_VISIT, ignore_case=True)
J_AMOUNT = java(AMOUNT)
# The two searches over the joined agent text, cut where a segment boundary may fall.
J_AMOUNT_OPEN = java(r"\b\d+\s*$")
J_AMOUNT_CLOSE = java(r"^\s*manat\b")
J_VISIT_OPEN = java(r"bu\s+gün(\s|$)", ignore_case=True)
J_VISIT_CLOSE = java(r"texnik", ignore_case=True)
J_MULTI_STAR = java(MULTI_STAR)

