import numpy as np

from parley.llm import language, queries
from parley.llm.common import fold


def brute_profile(text, dims):
    """Letter by letter."""
    text, letters = f" {text.lower()} ", []
    for c in text:
        c = c if c.isalpha() else " "
        if not (c == " " and letters and letters[-1] == " "):
            letters.append(c)
    out = np.zeros(dims)
    vec = {c: language.letter_vectors(np.array([ord(c)]), dims)[0].astype(float) for c in set(letters)}
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        out += np.roll(vec[a], 2) * np.roll(vec[b], 1) * vec[c]
    return out


def test_profiles_against_brute_force(texts):
    some = [t for _, t in texts[:8]] + ["", " a ", "é1ñ", "漢字仮名", "a\n\nb"]
    found = language.Profiles(some, 64, {}).bundle(np.arange(len(some)), len(some), np.float64)
    for t, v in zip(some, found):
        assert np.array_equal(v, brute_profile(t, 64)), t[:30]


def test_wide_alphabets_take_the_sorting_path():
    text = "".join(chr(0x4E00 + i) for i in range(300))
    p = language.Profiles([text], 32, {})
    assert np.array_equal(p.bundle(np.zeros(1, dtype=int), 1, np.float64)[0], brute_profile(text, 32))


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op8_language(spark, sf).collect()
    assert len(rows) == len(langs) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, odd, empty):
    model = language.train(odd.withColumn("lang", odd["score"]))
    rows = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[1]["score"] == 0
    assert rows[4]["lang_pred"] == "z"
    none = language.train(empty)
    assert none.names == () and {r["lang_pred"] for r in language.predict(odd, none).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0
