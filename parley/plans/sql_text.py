"""DuckDB SQL fragments for the text oracles (RE2 dialect).

RE2's ``\\b``, ``\\w``, ``\\s`` are ASCII-only. ``ascii_view`` maps the text, code point for code
point, to ASCII with the same word/space structure (other whitespace -> tab, other word characters
-> '_', everything else -> '#'); patterns run there and values are cut from the original text by
position, which reproduces Unicode boundaries without look-around.
"""

from __future__ import annotations

UWS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
UW = r"\pL\pN_"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ascii_view(t: str) -> str:
    a = f"regexp_replace({t}, '[\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{0B}}]', chr(9), 'g')"
    b = f"regexp_replace({a}, '[^\\pL\\pN_\\x{{00}}-\\x{{7F}}]', '#', 'g')"
    return f"regexp_replace({b}, '[^\\x{{00}}-\\x{{7F}}]', '_', 'g')"


def norm_ws(t: str) -> str:
    return f"trim(regexp_replace({t}, '[{UWS}]+', ' ', 'g'))"


def match_starts(a: str, pat: str) -> str:
    """0-based starts of all matches of ``pat`` in ASCII text ``a`` (list)."""
    m = f"regexp_extract_all({a}, {q(pat)})"
    g = f"string_split_regex({a}, {q(pat)})"
    return (f"list_transform(range(1, len({m}) + 1), lambda k: "
            f"coalesce(list_sum(list_transform({g}[1:k], lambda x: length(x))), 0) + "
            f"coalesce(list_sum(list_transform({m}[1:k-1], lambda x: length(x))), 0))")


def match_lens(a: str, pat: str) -> str:
    return f"list_transform(regexp_extract_all({a}, {q(pat)}), lambda x: length(x))"


# RE2 forms of the detectors (run on the ASCII view).
RE2 = {
    "card": r"\b(?:[0-9][ -]*?){13,19}\b",
    "fin": r"(?i)\b(?:FIN\s*kodu?m?\s*)?([0-9][A-Z0-9]{6,8})\b",
    "fin7": r"\b[A-Z0-9]{7}\b",
    "fin_digit_first": r"\b[0-9]{2}[A-Z]{2,3}[A-Z0-9]{4,6}\b",
    "cvv": r"(?i)\bCVV\b|\bCVC\b",
    "phone": r"(\+994|0)\s*[0-9]{2}[\s-]*[0-9]{3}[\s-]*[0-9]{2}[\s-]*[0-9]{2}",
    "phone_strict": r"(\+994\s?[0-9]{2}\s?[0-9]{3}\s?[0-9]{2}\s?[0-9]{2})|(\b0[0-9]{2}\s?[0-9]{3}\s?[0-9]{2}\s?[0-9]{2}\b)",
    "email": r"(?i)\b[\w\.-]+@[\w\.-]+\.\w+\b",
    "num34": r"\b[0-9]{3,4}\b",
}


def spans_list(t: str, kind: str, label: str) -> str:
    """List of {label, s, e} structs for one detector."""
    a = ascii_view(t)
    st, ln = match_starts(a, RE2[kind]), match_lens(a, RE2[kind])
    return (f"list_transform(range(1, len({ln}) + 1), lambda i: "
            f"{{'label': {q(label)}, 's': CAST({st}[i] AS INTEGER), 'e': CAST({st}[i] + {ln}[i] AS INTEGER)}})")


def count_of(t: str, kind: str) -> str:
    return f"len(regexp_extract_all({ascii_view(t)}, {q(RE2[kind])}))"


def has(t: str, kind: str) -> str:
    return f"regexp_matches({ascii_view(t)}, {q(RE2[kind])})"
