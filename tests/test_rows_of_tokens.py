"""Tokens stay in their text's row: no shuffle, sort or window gets them, and the results are those of the long forms."""

import random
import re

import pytest

import __spark_entry__ as entry
from conftest import SF001
from parley.operators import bio, metrics, spans, tokens


def _plan(spark, name):
    return entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_not_sorted(spark):
    plan = _plan(spark, "b1_tokens")
    assert "Window" not in plan and "Sort" not in plan
    docs = tokens.doc_frame(spark.createDataFrame([(1, " a  b" + " " * 300_000)], "doc_id int, text string"), "doc_id", "text")
    assert [tuple(r)[2:] for r in tokens.tokens_with_offsets(docs).collect()] == [(0, "a", 1, 2), (1, "b", 4, 5)]


@pytest.mark.parametrize("name", ["b3_bio_tags"])
def test_tagged_tokens_leave_their_row_last(spark, name):
    above = _plan(spark, name).split("Generate posexplode")[0]
    assert not any(op in above for op in ("Exchange", "Sort", "Join", "Window"))


@pytest.mark.parametrize("name", ["b4_spans_to_bio_rows", "b11_align_labels"])
def test_tagged_rows_gather_no_tokens(spark, name):
    plan = _plan(spark, name)
    assert "Generate posexplode(regexp_extract_all" not in plan and "token" not in "".join(x for x in plan.split("\n") if "Exchange" in x or "Sort" in x)
    assert "named_struct(ti" not in plan and "collect_list(struct(ti" not in plan


@pytest.mark.parametrize("name", ["b11_align_labels", "b4_spans_to_bio_rows", "b3_bio_tags", "d13_bio_spans"])
def test_texts_are_shuffled_once(spark, name):
    """Entities are found in the text's row, so no second copy of the texts is spread for them and joined."""
    plan = _plan(spark, name)
    assert plan.count("FileScan") == plan.count("REPARTITION_BY_COL") == 1 and "Join" not in plan


def test_entities_are_found_in_the_row(spark):
    texts = ["ab12cd3 and AB12CD3,4111 1111 1111 1111", "", None, "none", "0501234567 é 050 123 45 67\n+994501234567 ab12cd3" * 40]
    det = {"A": r"\d+", "B": "[a-z]{2,}", "C": "Z"}
    docs = tokens.doc_frame(spark.createDataFrame([(1, x) for x in texts], "doc_id int, text string").coalesce(1), "doc_id", "text", 2)
    want = [(row, [(m.start(), m.end(), label) for label, p in det.items() for m in re.finditer(p, x or "")]) for row, x in enumerate(texts)]
    held = {r.text: [(x.s, x.e, x.label) for x in r.found] for r in spans.with_entities(docs, "found", det).collect()}
    assert held == {x or "": w for x, (_, w) in zip(texts, want)}
    got = spans.regex_entities(docs, det).select("doc_id", "eo", "s", "e", "label").collect()
    assert sorted(tuple(r) for r in got) == sorted((1, i, *x) for _, w in want for i, x in enumerate(w))
    for tagger in (None, det):
        long = spans.entities_to_bio(tokens.tokens_with_offsets(docs), spans.regex_entities(docs, tagger)).collect()
        assert sorted(map(repr, spans.texts_to_bio(docs, tagger or spans.TAGGER_DETECTORS).collect())) == sorted(map(repr, long))
        assert sorted(map(repr, spans.detected_tags(docs, tagger).collect())) == sorted(repr(r) for r in long if r.tag != "O")


def test_many_entities_in_a_text(spark):
    """Time linear in the entities of a text: their list is made once, not for each tagged token."""
    n = 100_000
    docs = tokens.doc_frame(spark.createDataFrame([(1, "AB12CD3 x " * n)], "doc_id int, text string"), "doc_id", "text")
    assert spans.detected_tags(docs).count() == n


@pytest.mark.parametrize("name", ["m4_entity_f1", "m4_entity_f1_ids"])
def test_scores_join_no_tokens(spark, name):
    assert not any("Join" in x and "ti#" in x for x in _plan(spark, name).split("\n"))


def test_names_are_found_in_the_row(spark):
    assert "lead(" not in _plan(spark, "g4_person_names")
    names = spark.createDataFrame([("Ana",), ("Ana Maria de Souza",), ("Maria",), ("O'Neil Ray",), ("de Souza Lima",), (None,)], "name string")
    texts = [(1, "ANA maria  de souza lima met Ana Maria, o'neil\nray and ana "), (2, None), (2, "Maria"), (None, "İ ana")]
    docs = tokens.doc_frame(spark.createDataFrame(texts, "doc_id int, text string"), "doc_id", "text")
    for bound in (1_000_000, 0):
        in_row = spans.gazetteer_entities(docs, names, broadcast_max_rows=bound).collect()
        assert sorted(map(repr, in_row)) == sorted(map(repr, spans.gazetteer_entities(tokens.tokens_with_offsets(docs), names).collect()))
        assert len(in_row) == 7


def test_tags_in_the_row_equal_the_join(spark):
    """Entities of any place and length, overlapping, empty and beyond the text, in rows of one id."""
    rng = random.Random(3)
    texts = [(7, " ".join(rng.choice(["ab", "c", "d-e", "é"]) for _ in range(30))) for _ in range(6)] + [(8, None)]
    docs = tokens.doc_frame(spark.createDataFrame(texts, "doc_id int, text string").coalesce(1), "doc_id", "text", 2)
    ents = spark.createDataFrame([(r, i, f"l{i}", a, a + rng.randrange(15)) for r in range(5) for i, a in
                                  enumerate(rng.randrange(80) for _ in range(8))], "row long, eo int, label string, s int, e int")
    want = sorted(tuple(r) for r in spans.entities_to_bio(tokens.tokens_with_offsets(docs), ents).collect())
    assert sorted(tuple(r) for r in spans.texts_to_bio(docs, ents).collect()) == want
    rows = docs.where("row = 0").selectExpr("row", "doc_id as row_id", "text").join(ents.where("row = 0").groupBy("row").agg(
        spans.F.sort_array(spans.F.collect_list(spans.F.struct("eo", spans.F.col("s").alias("start"), spans.F.col("e").alias("end"), "label"))).alias("entities")), "row")
    got = bio.spans_corpus_to_bio(rows).first()
    assert list(zip(got.tokens, got.tags)) == [(t[3], t[6]) for t in want if t[0] == 0]


def test_entity_scores_equal_a_count_of_all_tokens(spark):
    """With skipped (0, 0) tokens inside and around entities, and a text that no side tags."""
    rng = random.Random(4)
    names, rows = ["O", "B-A", "I-A", "B-B", "I-B"], []
    for d in range(12):
        for i in range(25):
            at = (0, 0) if rng.random() < 0.2 else (i + 1, i + 2)
            rows.append((d, i, *at, *(rng.choice(names) if d else "O" for _ in "gp")))
    df = spark.createDataFrame(rows, "doc_id int, ti int, s int, e int, g string, p string")
    gold, pred = (df.selectExpr("doc_id", "ti", "s", "e", f"{c} as tag") for c in "gp")
    a, b = ({tuple(r) for r in spans.bio_to_spans(x).collect()} for x in (gold, pred))
    r = metrics.entity_f1(gold, pred).first()
    assert (r.tp, r.n_pred, r.n_gold) == (len(a & b), len(b), len(a))
    assert r.accuracy == round(sum(x[4] == x[5] for x in rows) / len(rows), 6)


def test_guardrail_scores_are_made_once(spark):
    from parley.functions import regex as rx
    assert rx.J_EMAIL not in _plan(spark, "d16_cascade")  # scored before, in the written table
