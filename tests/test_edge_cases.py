"""Odd inputs of the scoring, request and metric operators."""

import json

import pytest
from pyspark.sql import functions as F

from parley.operators import corpus, llm, metrics, nested, rules
from parley.operators.evaluation import evaluate_dataset
from parley.sources import calls
from parley.sources.lexicon import DEFAULT_LEXICON

SEG = "call_id string, pos int, speaker string, text string, start double, end double"


def both_layouts(spark, rows, lexicon=None):
    seg = spark.createDataFrame(rows, SEG)
    long = rules.to_long(rules.score_calls(seg, lexicon))
    good, _ = calls.normalize_payloads(calls.payloads_from_strings(calls.payloads_per_call(seg), "value"))
    whole = rules.to_long(nested.score_nested(good, lexicon))
    a, b = (sorted(tuple(r) for r in x.collect()) for x in (long, whole))
    assert a == b
    return {(r[0], r[1]): r for r in a}


def test_silence_marker_in_other_digits(spark):
    rows = [("a", 0, "operator", "salam", 0.0, 1.0), ("a", 1, "operator", "[٩٠ saniyə sükut]", 1.0, 2.0)]
    got = both_layouts(spark, rows)
    assert got[("a", "KR2.3")][2] == 1 and "٩٠" in got[("a", "KR2.3")][5]


def test_empty_brand_list_matches_nothing(spark):
    lex = {**DEFAULT_LEXICON, "brand": [], "brand_word": []}
    rows = [("a", 0, "operator", "alo " + " ".join(DEFAULT_LEXICON["invite"][:1]), 0.0, 5.0),
            ("a", 1, "operator", " ".join(DEFAULT_LEXICON["closing"][:1]), 5.0, 9.0)]
    assert both_layouts(spark, rows, lex)[("a", "KR2.5")][2] == 1
    both_layouts(spark, rows, {**lex, "brand_word": ["a.b(", "x"]})  # words, not patterns


def test_labelled_items_with_one_call_id_stay_apart(spark):
    item = {"input": {"call_id": "same", "segments": [{"speaker": "operator", "text": "salam", "start": 0, "end": 5}]},
            "expected_output": {m: {"score": 1} for m in rules.METRICS}}
    payloads = calls.payloads_from_strings(spark.createDataFrame([(json.dumps(item),), (json.dumps(item),)], "s string"), "s")
    out = evaluate_dataset(payloads)
    assert {r.metric: r.total for r in out["accuracy"].collect()} == {**{m: 2 for m in rules.METRICS}, "ALL": 10}
    assert out["responses"].count() == 2 and out["scores"].count() == 10


def test_every_call_gets_requests_whatever_its_size(spark):
    text = "abcdefghi " * 1000
    rows = [("big", i, "operator", text, float(i), float(i) + 1) for i in range(200)] + [("small", 0, "operator", "salam", 0.0, 1.0)]
    req = llm.llm_requests(spark.createDataFrame(rows, SEG)).collect()
    assert {r.call_id for r in req} == {"big", "small"}
    parts = sorted((r.part, json.loads(r.user.split("Transcript (JSON):\n")[1].split("\n\nTask:")[0])["segments"]) for r in req if r.call_id == "big")
    assert [p for p, _ in parts] == list(range(len(parts))) and len(parts) > 1
    assert [s["start"] for _, p in parts for s in p] == [float(i) for i in range(200)]


def test_large_calls_are_scored_in_long_form(spark):
    rows = [("big", i, "operator", "x " * 600_000, float(i), float(i) + 1) for i in range(2)] + [("small", 0, "operator", "salam", 0.0, 1.0)]
    whole, large = calls.split_by_size(spark.createDataFrame(rows, SEG))
    assert {r.call_id for r in whole.select("call_id").collect()} == {"small"}
    assert rules.to_long(rules.score_calls(large)).count() == 5


def test_first_k_of_rows_that_the_keys_do_not_tell_apart(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k long")
    assert corpus.first_k(df, ["k"], 4).count() == 4
    assert corpus.first_k(spark.createDataFrame([(1,)] * 60_000, "k long"), ["k"], 2).count() == 2


def test_word_errors_of_many_distinct_words(spark):
    a = [f"w{i}" for i in range(70_000)]
    df = spark.createDataFrame([(" ".join(a[:3]), " ".join([a[0], "x", a[2], a[3]]))], "ref string, hyp string")
    assert metrics.word_edits(df).first()["edits"] == 2
    wide = spark.createDataFrame([("w0 w1", " ".join(a))], "ref string, hyp string")
    assert metrics.word_edits(wide.select(F.col("ref"), F.col("hyp"))).first()["edits"] == 69_998


def test_patterns_of_any_length_across_segments(spark):
    """The day and the technician far apart; a number that a cut must not shorten."""
    far = [("a", 0, "operator", "bu gün sizə mütləq gələcək ustamız olacaq", 0.0, 5.0), ("a", 1, "operator", "texnik adı Elvin", 5.0, 9.0),
           ("b", 0, "operator", "ref x12345678901234567890123456789012345678901234567890", 0.0, 5.0), ("b", 1, "operator", "manat", 5.0, 9.0),
           ("c", 0, "operator", "cəmi 12345678901234567890123456789012345678901234567890", 0.0, 5.0), ("c", 1, "operator", "manat", 5.0, 9.0),
           ("d", 0, "operator", "texnik adı Elvin", 0.0, 5.0), ("d", 1, "operator", "bu günlər bu gün", 5.0, 9.0)]
    from parley.sources.lexicon import TEST_LEXICON
    both_layouts(spark, far)
    got = both_layouts(spark, far, TEST_LEXICON)
    assert [got[(c, "KR2.1")][2] for c in "abcd"] == [3, 1, 3, 1]


def test_a_text_with_very_many_entities(spark):
    """100,000 phone numbers in one text, next to repeated and null ids."""
    from parley.operators import spans, tokens
    one = "+994 50 123 45 67"
    n = 100_000
    rows = [(1, f"{one}; " * n), (2, "nothing here"), (2, f"call {one}"), (2, f"call {one}"), (None, f"{one} x"), (3, None)]
    docs = tokens.doc_frame(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    masked = spans.mask_documents(docs, spans.merge_spans(spans.detected_spans(docs, {"PHONE": spans.rx.J_PHONE_STRICT})))
    got = sorted(((r.doc_id, r.n, r.m) for r in masked.selectExpr("doc_id", "size(entities) as n", "masked_text as m").collect()), key=repr)
    assert got == sorted([(1, n, "****; " * n), (2, 0, "nothing here"), (2, 1, "call ****"), (2, 1, "call ****"), (None, 1, "**** x"), (3, 0, "")], key=repr)


def test_tokens_of_rows_with_one_id(spark):
    from parley.operators import tokens
    rows = [(1, "a b c"), (1, "d e"), (None, "f")]
    docs = tokens.doc_frame(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    got = [(r.doc_id, r.ti, r.token) for r in tokens.tokens_with_offsets(docs).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 0, "d"), (1, 1, "e"), (None, 0, "f")], key=repr)


def test_samples_and_splits_of_repeated_keys(spark):
    """Exactly k rows, also where rows of one key lie on both sides of the cut or all rows are alike."""
    from parley.operators import corpus
    many = spark.createDataFrame([(i % 10,) for i in range(50)], "id int").repartition(4)
    same = spark.createDataFrame([(1,)] * 30, "id int").repartition(3)
    for df, n in ((many, 50), (same, 30)):
        for k in (1, 7, 20, n, n + 5):
            assert corpus.sample_exact(df, "id", k, 42).count() == min(k, n)
        split = corpus.split_exact(df, "id", 0.3, 42).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in split} == {"validation": int(n * 0.3), "train": n - int(n * 0.3)}
    few = corpus._kth(same.selectExpr("cast(id as long) as a", "cast(id as long) as b"), ["a", "b"], 3, 4096, 5)
    assert few == ((1, 1), True)


def test_names_of_several_tokens(spark):
    """The longest name at a token, none inside another, across signs and cases, up to the end of the text."""
    from parley.operators import spans, tokens
    names = spark.createDataFrame([("Ana",), ("Ana Maria de Souza",), ("Maria",), ("O'Neil Ray",), ("de Souza Lima",), (None,), ("  ",)], "name string")
    text = "ANA maria  de souza lima met Ana Maria, o'neil\nray and ana"
    docs = tokens.doc_frame(spark.createDataFrame([(1, text), (2, "nobody"), (2, "Maria")], "doc_id int, text string"), "doc_id", "text")
    toks = tokens.tokens_with_offsets(docs)
    for bound in (1_000_000, 0):
        found = spans.gazetteer_entities(toks, names, broadcast_max_rows=bound).collect()
        got = sorted((r.doc_id, text[r.s:r.e] if r.doc_id == 1 else "Maria") for r in found)
        assert got == sorted([(1, "ANA maria  de souza"), (1, "Ana"), (1, "Maria"), (1, "o'neil\nray"), (1, "ana"), (2, "Maria")])
    assert spans.gazetteer_entities(toks, names.limit(0)).count() == 0


def test_first_text_or_the_error(spark):
    from parley.functions.text import first_non_blank
    df = spark.createDataFrame([("a", " "), (" ", "b")], "x string, y string")
    assert [r[0] for r in df.select(first_non_blank(["x", "y"], required=True)).collect()] == ["a", "b"]
    none = spark.createDataFrame([(None, " ")], "x string, y string")
    assert none.select(first_non_blank(["x", "y"])).first()[0] is None
    with pytest.raises(Exception, match="no text in any of the columns x, y"):
        none.select(first_non_blank(["x", "y"], required=True)).collect()


def test_prompt_file(spark, tmp_path):
    from parley.operators.llm import read_prompt
    good = tmp_path / "p.yaml"
    good.write_text("system: be fair\nuser: |\n  Transcript (JSON):\n  {{transcript_json}}\n", encoding="utf-8")
    assert read_prompt(spark, str(good)) == {"system": "be fair", "user": "Transcript (JSON):\n{{transcript_json}}\n"}
    bad = tmp_path / "q.yaml"
    bad.write_text("system: only\n", encoding="utf-8")
    with pytest.raises(ValueError, match="user"):
        read_prompt(spark, str(bad))
