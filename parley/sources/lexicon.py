"""Rule lexicons as data.

A lexicon maps a list name to lower-case literal substrings. It is configuration, bounded in size
and independent of the data volume, so operators fold it into literal ``contains`` expressions on
the driver (no join, stays in codegen). ``lexicon_frame``/``lexicon_from_frame`` convert to and from
a ``(list_name, pattern)`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------------------------
# The call-centre lexicon (Azerbaijani/Russian/English) whose matches decide the
# scores; the brand word and invitation words of the greeting test; the silence evidence text.
# ---------------------------------------------------------------------------------------------
DEFAULT_LEXICON: dict[str, list[str]] = {
    "leak": ["rəhbərlik", "şirkət", "serverlər köhnədir", "investisiya etmir", "böhran",
             "bizim əlimizdən heç nə gəlmir"],
    "empathy": ["narahatçılığınızı başa düşürəm", "başa düşürəm", "narahat olmayın",
                "çox narahat edicidir", "üzr istəyirəm"],
    "pii_warning": ["kart məlumatlarını", "pasport məlumatlarını", "telefonda deməyin", "heç vaxt",
                    "təhlükəlidir", "dur!"],
    "hard_ask": ["cvv", "cvc"],
    "solution": ["manat", "mbps", "paket", "sms", "göndər", "link", "aktivləş", "aralığında", "saat",
                 "edə bilərsiniz", "tətbiq", "email", "terminal", "alternativ", "restart", "yenidən",
                 "modem", "router", "söndür", "qoş", "kabel", "wi-fi", "wifi", "texnik", "gələcək",
                 "filial", "ofis", "sənəd", "sənədlər", "şəxsiyyət"],
    "partial_registration": ["ticket açım", "ticket açaram", "qeyd edim", "qeyd edərəm", "ödəniş edildi",
                             "ödəniş uğurla"],
    "send_away": ["özün zəng et", "sonra zəng et", "geri zəng yoxdur"],
    "kr21_bad_evidence": ["cvv", "cvc", "özün zəng et", "sonra zəng et", "rəhbərlik", "şirkət",
                          "serverlər köhnədir", "investisiya etmir", "böhran", "bizim əlimizdən heç nə gəlmir"],
    "solution_evidence_extra": ["manat"],
    "outcome_fail": ["rəhbərlik", "şirkət", "serverlər köhnədir", "investisiya etmir", "böhran",
                     "bizim əlimizdən heç nə gəlmir", "heç nə gəlmir"],
    "paid": ["ödəniş edildi", "ödəniş uğurla"],
    "ticket": ["ticket aç"],
    "ticket_evidence": ["ticket açım", "ticket açaram", "ticket aç"],
    "checking": ["məlumat yoxlayıram", "yoxlayıram", "məbləğ nə qədərdir", "mebleg ne qederdir"],
    "kr25_bad_evidence": ["cvv", "cvc", "rəhbərlik", "serverlər", "investisiya", "böhran", "əlimizdən"],
    "kr25_good_evidence": ["dur", "təhlük", "başa düşürəm", "üzr", "kontakt home", "yaxşı gün", "rica"],
    "greeting": ["salam", "здравств", "привет", "hello"],
    "brand": ["kontakt home"],
    "brand_word": ["kontakt"],
    "invite": ["buyur", "buyurun"],
    "closing": ["yaxşı gün", "rica edir", "sağ olun", "təşəkkür", "tesekkur", "thank you", "спасибо",
                "всего добр", "до свид"],
}
NO_AGENT_EVIDENCE = "[0-0] Operator: (boş)"
SILENCE_EVIDENCE_TEXT = "[uzun sükut/gözləmə]"
# ---------------------------------------------------------------------------------------------

# Lexicon fitted to the invented en/fr/es/de vocabulary of the test tables, so that every rule
# branch that derived data can reach is populated there (word shares measured on conversations
# sf0.01; branch counts checked on sf0.01 and sf0.1 - only "too short" cannot occur).
TEST_LEXICON: dict[str, list[str]] = {
    "leak": [" los ", " para "],
    "empathy": [" les "],
    "pii_warning": [" que "],
    "hard_ask": [" est "],
    "solution": [" this "],
    "partial_registration": [" with "],
    "send_away": [" dans "],
    "kr21_bad_evidence": [" est ", " dans ", " los ", " para "],
    "solution_evidence_extra": [],
    "outcome_fail": [" los ", " para ", " der "],
    "paid": [" und ", " que ", " der "],
    "ticket": [" les ", " est ", " von "],
    "ticket_evidence": [" les ", " est ", " von "],
    "checking": [" for "],
    "kr25_bad_evidence": [" est ", " los "],
    "kr25_good_evidence": [" que ", " les ", " was "],
    "greeting": ["the"],
    "brand": ["acme store"],
    "brand_word": ["acme"],
    "invite": ["welcome in"],
    "closing": [" was "],
}


def lexicon_frame(spark: SparkSession, lexicon: dict[str, list[str]] = DEFAULT_LEXICON) -> DataFrame:
    rows = [(name, p) for name, pats in lexicon.items() for p in pats]
    return spark.createDataFrame(rows, "list_name string, pattern string")


def lexicon_from_frame(df: DataFrame) -> dict[str, list[str]]:
    """Fold a (list_name, pattern) table into a dict on the driver (configuration-sized input)."""
    out: dict[str, list[str]] = {}
    for r in df.select("list_name", "pattern").collect():
        out.setdefault(r["list_name"], []).append(r["pattern"].lower())
    return out


def max_pattern_chars(lexicon: dict[str, list[str]]) -> int:
    return max((len(p) for pats in lexicon.values() for p in pats), default=1)
