"""The chunked (hot-key-safe) ordered scan equals the plain per-key scan."""

from pyspark.sql import functions as F

from conftest import SF01
from parley.operators.sequence import ordered_context
from parley.sources.tables import read_table


def _collect(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_split_equals_unsplit_on_one_hot_key(spark):
    conv = read_table(spark, SF01, "conversations")
    # every row in ONE group: the worst skew; order by (conv_id, turn) within it
    hot = conv.select(F.lit(1).alias("k"), "conv_id", "turn", F.length("text").alias("n"),
                      F.lower("text").alias("t"))
    plain = ordered_context(hot, "k", ["conv_id", "turn"], lags=["n"], sums=["n"], tail="t", tail_chars=12,
                            chunks=1)
    split = ordered_context(hot, "k", ["conv_id", "turn"], lags=["n"], sums=["n"], tail="t", tail_chars=12,
                            chunks=7, per_chunk=16)
    cols = ["conv_id", "turn", "prev_n", "cum_n", "prev_tail"]
    assert _collect(plain, cols) == _collect(split, cols)


def test_split_equals_unsplit_many_keys(spark):
    conv = read_table(spark, SF01, "conversations").withColumn("t", F.when(F.col("turn") % 3 == 0, F.lit("")).otherwise(F.col("text")))
    a = ordered_context(conv, "conv_id", ["turn"], lags=["turn"], sums=["turn"], tail="t", tail_chars=5, chunks=1)
    b = ordered_context(conv, "conv_id", ["turn"], lags=["turn"], sums=["turn"], tail="t", tail_chars=5, chunks=9,
                        per_chunk=8)
    cols = ["conv_id", "turn", "prev_turn", "cum_turn", "prev_tail"]
    assert _collect(a, cols) == _collect(b, cols)


def test_tail_matches_python_join(spark):
    rows = [(1, i, t) for i, t in enumerate(["ab", "", "", "cdef", "g", "", "hij"])]
    df = spark.createDataFrame(rows, "k int, o int, t string")
    for chunks in (1, 3):
        out = {r.o: r.prev_tail for r in ordered_context(df, "k", ["o"], tail="t", tail_chars=4, chunks=chunks,
                                                          per_chunk=2).collect()}
        texts = [r[2] for r in rows]
        for i in range(len(rows)):
            want = " ".join(texts[:i])[-4:] if i else None
            assert out[i] == want, (chunks, i, out[i], want)


def test_scoring_split_path_equals_plain(spark):
    """The full scorer with the range-split ordered scan forced on equals the plain per-call windows."""
    from parley.operators import rules, segments
    from parley.sources.lexicon import TEST_LEXICON
    conv = read_table(spark, SF01, "conversations")
    seg = segments.conversation_segments(conv, chunks=1)
    plain = rules.to_long(rules.score_calls(seg, TEST_LEXICON, role="assistant", chunks=1))
    split = rules.to_long(rules.score_calls(seg, TEST_LEXICON, role="assistant", chunks=6, per_chunk=8))
    a = sorted(tuple(r) for r in plain.collect())
    b = sorted(tuple(r) for r in split.collect())
    assert a == b and len(a) == 500


def test_scoring_one_hot_call(spark):
    """Every segment in one call: split scoring equals plain scoring (the worst skew)."""
    from parley.operators import rules, segments
    from parley.sources.lexicon import TEST_LEXICON
    conv = read_table(spark, SF01, "conversations")
    seg = segments.conversation_segments(conv, chunks=1)
    hot = seg.withColumn("pos", (F.col("call_id").cast("int") * 100 + F.col("pos")).cast("int")) \
             .withColumn("start", F.col("start") + F.col("call_id").cast("double") * 10000) \
             .withColumn("end", F.col("end") + F.col("call_id").cast("double") * 10000) \
             .withColumn("call_id", F.lit("hot"))
    plain = rules.to_long(rules.score_calls(hot, TEST_LEXICON, role="assistant", chunks=1)).collect()
    split = rules.to_long(rules.score_calls(hot, TEST_LEXICON, role="assistant", chunks=8, per_chunk=8)).collect()
    assert sorted(tuple(r) for r in plain) == sorted(tuple(r) for r in split)


def test_derived_times_split(spark):
    from parley.operators import segments
    conv = read_table(spark, SF01, "conversations")
    a = sorted(tuple(r) for r in segments.derive_times(conv, chunks=1).collect())
    b = sorted(tuple(r) for r in segments.derive_times(conv, chunks=5, per_chunk=8).collect())
    assert a == b


def test_split_path_in_other_callers(spark):
    """Validator and WER pairs give the same results with forced ranges."""
    from parley.operators import llm, metrics, rules, segments
    from parley.sources.lexicon import TEST_LEXICON
    conv = read_table(spark, SF01, "conversations")
    c = conv.select("conv_id", "turn", "text")
    assert _collect(metrics.wer(metrics.consecutive_pairs(c, "conv_id", ["turn"], "text", chunks=1)), ["edits", "ref_words"]) == \
        _collect(metrics.wer(metrics.consecutive_pairs(c, "conv_id", ["turn"], "text", chunks=5)), ["edits", "ref_words"])
    seg = segments.conversation_segments(conv, chunks=1)
    wide = rules.score_calls(seg, TEST_LEXICON, role="assistant", chunks=1)
    parsed = llm.parse_answers(llm.answers_from_rules(rules.to_long(wide), seg, "assistant"))
    v1 = llm.validate_answers(parsed, seg, chunks=1).select("call_id", "valid")
    v2 = llm.validate_answers(parsed, seg, chunks=6).select("call_id", "valid")
    assert _collect(v1, ["call_id", "valid"]) == _collect(v2, ["call_id", "valid"])


def test_split_with_nulls_and_mixed_types(spark):
    """NULL order values and string/double/timestamp sort fields: split path = plain path."""
    conv = read_table(spark, SF01, "conversations")
    df = conv.select(
        (F.col("conv_id") % 3).alias("k"),
        F.when(F.col("turn") % 5 == 0, F.lit(None)).otherwise(F.col("role")).alias("o1"),
        F.when(F.col("turn") % 7 == 0, F.lit(None)).otherwise(F.length("text") / 7.0).alias("o2"),
        F.timestamp_seconds(F.col("conv_id") * 1000 + F.col("turn")).alias("o3"),
        F.col("conv_id"), F.col("turn"), F.length("text").alias("n"))
    order = ["o1", "o2", "o3", "conv_id", "turn"]
    a = ordered_context(df, "k", order, lags=["n"], sums=["n"], chunks=1)
    b = ordered_context(df, "k", order, lags=["n"], sums=["n"], chunks=9)
    cols = ["conv_id", "turn", "prev_n", "cum_n"]
    assert _collect(a, cols) == _collect(b, cols)
