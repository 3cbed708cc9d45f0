"""Readers, writers and small helpers."""

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from parley.operators import bio, spans, tokens
from parley.sources import calls as cl
from parley.sources import files, lexicon, tables


def _tmp():
    return tempfile.mkdtemp(prefix="parley-io-", dir="/tmp")


def test_payload_array_file(spark):
    d = _tmp()
    p = os.path.join(d, "eval.json")
    items = [{"dataset_id": "d1", "input": {"call_id": "a", "segments": [{"speaker": "Operator", "text": "Salam", "start": 0, "end": 1}]},
              "expected_output": {"KR2.1": {"score": 1}}},
             {"call_id": "b", "segments": []}]
    with open(p, "w", encoding="utf-8") as f:
        json.dump(items, f, ensure_ascii=False)
    calls, rejects = cl.normalize_payloads(cl.read_payload_array(spark, p))
    assert sorted((r.call_id, r.dataset_id, len(r.segments)) for r in calls.collect()) == [("a", "d1", 1), ("b", None, 0)]
    assert rejects.count() == 0
    ids = cl.read_payload_array(spark, p).select(cl.effective_call_id(F.col("v")).alias("c"))
    assert sorted(r.c for r in ids.collect()) == ["a", "b"]


def test_effective_call_id_default(spark):
    df = cl.payloads_from_strings(spark.createDataFrame([('{"input": {"call_id": ""}}',)], "s string"), "s")
    assert df.select(cl.effective_call_id(F.col("v"))).first()[0] == "UNKNOWN_CALL_ID"


def test_jsonl_roundtrip_partitioned(spark):
    d = _tmp()
    df = spark.createDataFrame([("Salam, mənim adım Elvin", 1, "train"), ("çay", 0, "validation")],
                               "text string, label int, split string")
    files.write_jsonl(df, os.path.join(d, "c"), partition_by=["split"])
    back = files.read_jsonl(spark, os.path.join(d, "c"), "text string, label int, split string")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    raw = open([os.path.join(dp, f) for dp, _, fs in os.walk(os.path.join(d, "c")) for f in fs if f.endswith(".json")][0],
               encoding="utf-8").read()
    assert "ə" in raw or "ç" in raw                      # UTF-8 kept, not \\u-escaped
    v = back.where(F.col("split") == "validation")       # partition filter
    assert v.count() == 1


def span_rows(spark):
    """Documents of the smallest table with the spans the detectors find in them."""
    docs = tokens.doc_frame(spark.read.parquet(f"{SF001}/documents.parquet"), "doc_id", "text")
    ents = spans.regex_entities(docs).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(F.col("s").alias("start"), F.col("e").alias("end"), "label"))).alias("entities"))
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    return docs.join(ents, "row", "left").select(F.col("doc_id").alias("row_id"), "text", F.coalesce("entities", none).alias("entities"))


def test_span_rows_roundtrip(spark):
    d = _tmp()
    rows = span_rows(spark)
    files.write_jsonl(rows, os.path.join(d, "spans"))
    back = files.read_jsonl(spark, os.path.join(d, "spans"),
                            "row_id long, text string, entities array<struct<start:int,end:int,label:string>>")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())


def test_span_rows_to_bio(spark):
    """A tagged character belongs to a span's token, the first token of a span has the B tag."""
    rows = {r.row_id: r for r in span_rows(spark).collect()}
    conv = {r.row_id: r for r in bio.spans_corpus_to_bio(span_rows(spark)).collect()}
    assert conv.keys() == rows.keys()
    assert any(r.entities for r in rows.values()) and not all(r.entities for r in rows.values())
    for i, r in rows.items():
        toks = [(m.start(), m.end()) for m in re.finditer(r"\w+|[^\w\s]", r.text)]
        assert conv[i].tokens == [r.text[s:e] for s, e in toks]
        assert {k for k, t in enumerate(conv[i].tags) if t != "O"} == {
            k for k, (s, e) in enumerate(toks) for x in r.entities if s < x.end and e > x.start}


def test_text_column_and_required(spark):
    df = spark.createDataFrame([("a", "b")], "transcript string, sentence string")
    assert tables.find_text_column(df) == "sentence"
    with pytest.raises(ValueError, match="the table has"):
        tables.find_text_column(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError, match="the table has"):
        tables.require_columns(df, ["audio"])


def test_lexicon_frame_roundtrip(spark):
    lf = lexicon.lexicon_frame(spark, lexicon.DEFAULT_LEXICON)
    back = lexicon.lexicon_from_frame(lf)
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(p.lower() for p in v) for k, v in lexicon.DEFAULT_LEXICON.items()}


def test_report_writer(spark):
    d = _tmp()
    rows = spark.createDataFrame([("pytorch", 1.518), ("onnx", 1.5463)], "backend string, latency_s double")
    md = files.write_report(rows, os.path.join(d, "r"), "ASR")
    assert "| backend | latency_s |" in md and "| onnx | 1.5463 |" in md
    assert json.loads(files.report_record(rows, "backend", "latency_s"))["pytorch"] == 1.518


def test_cascade_truncation_and_gazetteer(spark):
    docs = spark.createDataFrame([(1, "Mən Elvin Aliyev, kart 4169 1234 5678 9012 və telefon +994 50 123 45 67"),
                                  (2, "Salam, sabah görüşərik.")], "doc_id int, text string")
    names = spark.createDataFrame([("Elvin",), ("Aliyev",)], "name string")
    score = F.when(F.col("doc_id") == 1, F.lit(0.9)).otherwise(F.lit(0.1))
    full = {r.doc_id: r for r in spans.cascade(docs, score, names=names).collect()}
    assert full[2].masked_text == "Salam, sabah görüşərik." and not full[2].is_unsafe
    assert full[1].masked_text == "Mən ****, kart **** və telefon ****"
    assert [(e.label, e.text) for e in full[1].entities] == [("PERSON", "Elvin Aliyev"), ("CARD", "4169 1234 5678 9012"),
                                                              ("PHONE", "+994 50 123 45 67")]
    cut = {r.doc_id: r for r in spans.cascade(docs, score, max_tokens=5, names=names).collect()}
    assert cut[1].truncated and cut[1].masked_text.startswith("Mən ****, kart 4169")


def test_tokens_offsets_match_python(spark):
    d = tables.read_table(spark, SF001, "documents", ["doc_id", "text"])
    got = {}
    for r in tokens.tokens_with_offsets(tokens.doc_frame(d, "doc_id", "text")).collect():
        got.setdefault(r.doc_id, []).append((r.ti, r.token, r.s, r.e))
    tok_re = re.compile(r"\w+|[^\w\s]")
    for r in d.collect():
        want = [(i, m.group(0), m.start(), m.end()) for i, m in enumerate(tok_re.finditer(r.text or ""))]
        assert sorted(got.get(r.doc_id, [])) == want


def test_quorum_check():
    from parley.operators.corpus import quorum_check
    with pytest.raises(RuntimeError, match="unsafe input is empty"):
        quorum_check(0, 5000)
    with pytest.raises(RuntimeError, match="safe sentences for"):
        quorum_check(2000, 999)                      # below the 1,000 floor
    with pytest.raises(RuntimeError, match="safe sentences for"):
        quorum_check(10000, 5999)                    # below 0.6 * n_unsafe
    quorum_check(10000, 6000)
    quorum_check(10, 6, floor=0)                     # the 60 % rule still applies without a floor
    with pytest.raises(RuntimeError, match="safe sentences for"):
        quorum_check(10, 5, floor=0)


def test_prompt_check():
    from parley.operators.llm import USER_TEMPLATE, check_prompt
    assert "{{transcript_json}}" in USER_TEMPLATE
    check_prompt({"system": "s", "user": "u"})
    with pytest.raises(ValueError, match="mapping"):
        check_prompt(["system", "user"])
    with pytest.raises(ValueError, match="lacks"):
        check_prompt({"system": "s"})
