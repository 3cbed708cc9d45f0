"""Payload normalisation cases (FIXTURES section 3) and payload-path scoring = direct scoring."""

import json

from pyspark.sql import functions as F

from conftest import SF001
from parley.operators import rules, segments
from parley.sources import calls as cl
from parley.sources.lexicon import TEST_LEXICON
from parley.sources.tables import read_table


def _norm(spark, payloads):
    df = spark.createDataFrame([(json.dumps(p) if not isinstance(p, str) else p,) for p in payloads], "s string")
    return cl.normalize_payloads(cl.payloads_from_strings(df, "s"))


def test_normalisation_cases(spark):
    p = {"call_id": "a", "segments": [
        {"speaker": " Operator ", "text": "hi", "start_time": 1, "end_time": 2},
        5,
        {"speaker": "C", "start": None, "start_time": 3, "end": 5},
        {"speaker": "D", "text": "...", "start": 9, "end": 4},
        {"speaker": "E", "start": 7, "end": "abc"},
        {"speaker": "F", "text": "x", "start": "0.5", "end": " 6 "},
    ]}
    calls, rejects = _norm(spark, [p])
    assert rejects.count() == 0
    row = calls.first()
    segs = [(s.pos, s.speaker, s.text, s.start, s.end, s.blank) for s in row.segments]
    assert row.n_dropped == 1
    assert segs == [
        (2, "C", "", 0.0, 0.0, True),      # start present but null -> both forced to 0.0
        (4, "E", "", 0.0, 0.0, True),      # "abc" end -> both 0.0
        (5, "F", "x", 0.5, 6.0, False),    # numeric strings
        (0, "Operator", "hi", 1.0, 2.0, False),  # aliases, speaker stripped
        (3, "D", "...", 4.0, 9.0, True),   # swapped, broken text kept and flagged
    ]
    assert row.n_blank == 3


def test_rejects_and_unwrap(spark):
    calls, rejects = _norm(spark, [{"call_id": 7, "segments": []}, {"call_id": "", "segments": []},
                                   {"call_id": "x", "segments": {}}, {"dataset_id": "d", "input": {"call_id": "w", "segments": []}},
                                   "[1, 2]"])
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["Missing or invalid call_id", "Missing or invalid call_id", "Missing or invalid segments list",
                       "payload is not an object"]
    (w,) = calls.collect()
    assert (w.call_id, w.dataset_id, w.segments) == ("w", "d", [])


def test_equal_times_keep_input_order(spark):
    calls, _ = _norm(spark, [{"call_id": "a", "segments": [{"text": "b", "start": 1, "end": 1},
                                                          {"text": "a", "start": 1, "end": 1}]}])
    assert [s.text for s in calls.first().segments] == ["b", "a"]


def test_payload_path_scores_equal_direct_scores(spark):
    conv = read_table(spark, SF001, "conversations")
    calls, rejects = cl.normalize_payloads(cl.payloads_from_conversations(conv))
    assert rejects.count() == 0
    via_payload = rules.to_long(rules.score_calls(cl.segments_long(calls), TEST_LEXICON, role="assistant"))
    direct = rules.to_long(rules.score_calls(segments.conversation_segments(conv), TEST_LEXICON, role="assistant"))
    a = sorted(tuple(r) for r in via_payload.collect())
    b = sorted(tuple(r) for r in direct.collect())
    assert a == b and len(a) > 0


def test_containers_as_python_writes_them(spark):
    import json
    values = [[], {}, ["a"], {"k": [1, None, True, False, "it's"]}, ['say "x"', "a'b\"c", "back\\slash", "line\nbreak\ttab"], [[], {}], ["a, b: [c]"]]
    rows = [(i, json.dumps({"call_id": "c", "segments": [{"speaker": v, "text": v}]})) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string").selectExpr("i", "parse_json(s) as v")
    got = {r.i: r.segments[0].text for r in cl.normalize_payloads(df, keep=("i",))[0].collect()}
    assert got == {i: str(v or "") for i, v in enumerate(values)}
