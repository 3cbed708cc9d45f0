"""The registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (or data Spark derives from them); names carry the
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pii as pii_fn
from ..functions.text import first_non_blank, normalize_ws
from ..operators import bio as bio_op
from ..operators import corpus as corp
from ..operators import llm as llm_op
from ..operators import metrics as met
from ..operators import models as mdl
from ..operators import rules, segments
from ..operators import sentences as sent_op
from ..operators import spans as span_op
from ..operators import tokens as tok_op
from ..sources import calls as call_src
from ..sources.lexicon import TEST_LEXICON
from ..sources.tables import balanced, profile
from ..sources.tables import read_table
from ..streaming import jobs

AGENT_ROLE = "assistant"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def conv_chunks(spark: SparkSession, sf: str) -> int:
    """Split decision for the ordered scans over conversation segments: one segment per table row,
    and a Parquet row count is answered from file metadata (no pass over the data)."""
    from ..operators.sequence import chunk_count
    return chunk_count(read_table(spark, sf, "conversations", ["conv_id"]).count(), spark)


def conv_segments(spark: SparkSession, sf: str, numeric_id: bool = False) -> DataFrame:
    return segments.conversation_segments(read_table(spark, sf, "conversations"), numeric_id=numeric_id,
                                          chunks=conv_chunks(spark, sf))


@register("r6_score_calls")
def score_calls_long(spark, sf):
    wide = rules.score_calls(conv_segments(spark, sf, numeric_id=True), TEST_LEXICON, role=AGENT_ROLE,
                             chunks=conv_chunks(spark, sf))
    return rules.to_long(wide)


@register("m1_score_distribution")
def score_distribution(spark, sf):
    """Flagship: score calls, then the per-metric score distribution with a ROLLUP total."""
    long = score_calls_long(spark, sf)
    g = (long.rollup("metric", "score").agg(F.count(F.lit(1)).alias("n_calls"))
         .where(F.col("metric").isNotNull() | F.col("score").isNull()))
    return g.select(F.coalesce("metric", F.lit("ALL")).alias("metric"),
                    F.coalesce("score", F.lit(-1)).alias("score"), "n_calls")


# ------------------------------------------------------------------ text scans and normalisation

# fixed values: text column names in order of preference
TEXT_CANDIDATES = ["text", "content", "body", "article", "document", "sentence"]


@register("s9_profile_documents")
def profile_documents(spark, sf):
    return profile(read_table(spark, sf, "documents"), "text", 250, order_col="doc_id")


@register("s5_first_text_pages")
def first_text_pages(spark, sf):
    p = read_table(spark, sf, "pages")
    strings = [f.name for f in p.schema.fields if f.dataType.simpleString() == "string"]
    order = [c for c in TEXT_CANDIDATES if c in strings] + [c for c in strings if c not in TEXT_CANDIDATES]
    return p.select("page_id", first_non_blank(order).alias("text"))


@register("n15_normalize_ws")
def normalize_documents(spark, sf):
    d = balanced(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    return d.select("doc_id", normalize_ws("text").alias("text_norm"))


@register("n16_sentences")
def sentences_documents(spark, sf):
    d = balanced(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    return sent_op.sentences(d, "doc_id", "text", 25, 280)


@register("n17_sentences_ellipsis")
def sentences_ellipsis(spark, sf):
    d = balanced(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    return sent_op.sentences(d, "doc_id", "text", 10, 240, enders=".!?…")


# ------------------------------------------------------------------ PII detection and redaction
def _docs(spark, sf):
    return balanced(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), "doc_id")


@register("d1_card_numbers")
def card_numbers(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.posexplode(pii_fn.matches("text", "card")).alias("idx", "value"))


@register("d2_fin_codes")
def fin_codes(spark, sf):
    d = _docs(spark, sf)
    x = d.select("doc_id", pii_fn.count("text", "fin").alias("n_fin"),
                 pii_fn.has("text", "fin7").alias("has_fin7"),
                 pii_fn.count("text", "fin_digit_first").alias("n_fin_digit_first"))
    return x.where((F.col("n_fin") > 0) | F.col("has_fin7") | (F.col("n_fin_digit_first") > 0))


@register("d3_cvv_by_lang")
def cvv_by_lang(spark, sf):
    d = _docs(spark, sf)
    n = pii_fn.count("text", "cvv")
    return d.groupBy("lang").agg(F.count_if(n > 0).alias("n_docs_cvv"), F.sum(n).alias("n_cvv"),
                                 F.count(F.lit(1)).alias("n_docs"))


@register("d4_phones")
def phones(spark, sf):
    d = _docs(spark, sf)
    x = d.select("doc_id", pii_fn.count("text", "phone").alias("n_phone"),
                 pii_fn.count("text", "phone_strict").alias("n_phone_strict"))
    return x.where((F.col("n_phone") > 0) | (F.col("n_phone_strict") > 0))


@register("d5_emails")
def emails(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.posexplode(pii_fn.matches("text", "email")).alias("idx", "value"))


@register("d6_looks_like_pii")
def looks_like(spark, sf):
    d = _docs(spark, sf)
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"),
                                 F.count_if(pii_fn.looks_like("text", "corpus")).alias("n_corpus_variant"),
                                 F.count_if(pii_fn.looks_like("text", "explore")).alias("n_explore_variant"))


@register("d7_find_pii")
def find_pii(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.posexplode(pii_fn.find_pii("text")).alias("idx", "f")).select(
        "doc_id", "idx", F.col("f.kind").alias("kind"), F.col("f.value").alias("value"))


@register("d8_redact")
def redact(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", pii_fn.redact("text").alias("redacted"))


@register("d9_conversation_pii")
def conversation_pii(spark, sf):
    c = read_table(spark, sf, "conversations", ["conv_id", "text"])
    hit = pii_fn.contains_pii("text")
    return c.groupBy("conv_id").agg(F.count_if(hit).alias("n_turns_pii"), F.bool_or(hit).alias("any_pii"))


# ------------------------------------------------------------------ tokens, BIO, spans, masking
def _doc_frame(spark, sf):
    return tok_op.doc_frame(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")


@register("b1_tokens")
def tokens(spark, sf):
    return tok_op.tokens_with_offsets(_doc_frame(spark, sf)).drop("row")


@register("b3_bio_tags")
def bio_tags(spark, sf):
    """Every token of every document with its tag."""
    docs = _doc_frame(spark, sf)
    return span_op.texts_to_bio(docs, span_op.TAGGER_DETECTORS).select("doc_id", "ti", "token", "tag")


@register("d13_bio_spans")
def bio_spans(spark, sf):
    return span_op.detected_spans(_doc_frame(spark, sf)).drop("row")


@register("d14_merged_spans")
def merged_spans(spark, sf):
    return span_op.merge_spans(span_op.detected_spans(_doc_frame(spark, sf))).drop("row")


@register("d15_masked_documents")
def masked_documents(spark, sf):
    """Every document, masked where it holds an entity."""
    docs = _doc_frame(spark, sf)
    m = span_op.mask_documents(docs, span_op.merge_spans(span_op.detected_spans(docs)))
    return m.select("doc_id", "masked_text", F.size("entities").alias("n_entities"))


@register("g4_person_names")
def person_names(spark, sf):
    """Names of several tokens as entities; the list is taken from the table ``benchmark`` (the first three words of each item)."""
    words = F.split(normalize_ws("text"), " ")
    names = read_table(spark, sf, "benchmark", ["text"]).select(F.array_join(F.slice(words, 1, 3), " ").alias("name"))
    found = span_op.gazetteer_entities(_doc_frame(spark, sf), names)
    return found.select("doc_id", "label", "s", "e")


@register("d16_cascade")
def cascade_documents(spark, sf):
    docs = balanced(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    l0, l1 = span_op.regex_guardrail_logits(F.col("text"))
    # four regex scans of every text cost more than a copy of it: scores are written once, not made again by each branch
    out = span_op.cascade(docs, span_op.softmax_p1(l0, l1), threshold=0.5, write_scores=True)
    return out.select("doc_id", "is_unsafe", F.round("guardrail_score", 6).alias("guardrail_score"), "masked_text")


# ------------------------------------------------------------------ corpus: samples, quotas, splits

SEED = 42


def _labelled_docs(spark, sf):
    d = balanced(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id")
    lab = read_table(spark, sf, "labels", ["doc_id", "toxic"])
    return d.join(lab, "doc_id")


@register("l1_non_blank_texts")
def non_blank_texts(spark, sf):
    return corp.non_blank(read_table(spark, sf, "documents", ["doc_id", "text"]), "text")


@register("l2_sample_exact")
def sample_exact(spark, sf):
    return corp.sample_exact(read_table(spark, sf, "documents", ["doc_id", "lang"]), "doc_id", 100, SEED)


@register("l3_sentence_quota")
def sentence_quota(spark, sf):
    """First N safe sentences in source order, N = number of toxic documents."""
    ld = _labelled_docs(spark, sf)
    n = ld.where("toxic = 1").count()
    s = sent_op.sentences(ld.where("toxic = 0"), "doc_id", "text", 25, 280)
    s = s.withColumn("_d", F.col("doc_id").cast("bigint")).withColumn("_s", F.col("sent_no").cast("bigint"))
    return corp.take_quota(s, n, ["_d", "_s"]).select("doc_id", "sent_no", "sentence")


@register("l6_split_exact")
def split_exact(spark, sf):
    return corp.split_exact(read_table(spark, sf, "documents", ["doc_id"]), "doc_id", 0.1, SEED)


@register("l8_split_bucket")
def split_bucket(spark, sf):
    return corp.split_bucket(read_table(spark, sf, "documents", ["doc_id"]), "doc_id", 0.1, SEED)


@register("l9_subset_overlap")
def subset_overlap(spark, sf):
    """Train/eval subsets drawn from the same table with different seeds; overlap and disjoint sizes."""
    d = read_table(spark, sf, "documents", ["doc_id"])
    n = d.count()
    k_tr, k_ev = corp.subset_sizes(n, 0.1, 0.05)
    tr = corp.sample_exact(d, "doc_id", k_tr, SEED)
    ev = corp.sample_exact(d, "doc_id", k_ev, 123)
    both = ev.join(tr.select("doc_id", F.lit(1).alias("t")), "doc_id", "left")
    return both.agg(F.count("t").alias("n_overlap"), F.count_if(F.col("t").isNull()).alias("n_eval_disjoint")).select(
        F.lit(k_tr).cast("long").alias("n_train"), F.lit(k_ev).cast("long").alias("n_eval"), "n_overlap", "n_eval_disjoint")


def _corpus(spark, sf):
    ld = _labelled_docs(spark, sf)
    unsafe = ld.where("toxic = 1").select(F.col("doc_id").alias("key"), "text")
    safe = sent_op.sentences(ld.where("toxic = 0"), "doc_id", "text", 25, 280)
    # quorum floor is a parameter: the small test tables hold far fewer than 1000 sentences
    return corp.balanced_corpus(unsafe, safe, seed=SEED, val_ratio=0.1, filter_safe_pii=True, quorum_floor=0)


@register("l5_balanced_corpus")
def balanced_corpus(spark, sf):
    return _corpus(spark, sf)


@register("k2_corpus_meta")
def corpus_meta(spark, sf):
    return corp.corpus_meta(_corpus(spark, sf), SEED, 0.1, True)


@register("l7_validation_split")
def validation_split(spark, sf):
    return _corpus(spark, sf).where(F.col("split") == "validation")


# ------------------------------------------------------------------ evaluation metrics


def _two_configs(spark, sf):
    seg = conv_segments(spark, sf, numeric_id=True)
    n = conv_chunks(spark, sf)
    pred = rules.to_long(rules.score_calls(seg, TEST_LEXICON, role=AGENT_ROLE, gap_s=60.0, chunks=n))
    exp = rules.to_long(rules.score_calls(seg, TEST_LEXICON, role=AGENT_ROLE, gap_s=30.0, chunks=n))
    return pred, exp


@register("m1_rule_agreement")
def rule_agreement(spark, sf):
    """Agreement of the 60 s silence rule with a 30 s variant, per metric and overall."""
    pred, exp = _two_configs(spark, sf)
    return met.accuracy(pred, exp)


@register("m2_mismatches")
def rule_mismatches(spark, sf):
    pred, exp = _two_configs(spark, sf)
    return met.mismatches(pred, exp, metric="KR2.3", max_rows=50).select(
        "call_id", "metric", "score", "expected", "probability", "evidence_snippet")


def _guardrail_preds(spark, sf):
    ld = _labelled_docs(spark, sf)
    l0, l1 = span_op.regex_guardrail_logits(F.col("text"))
    return ld.select("doc_id", F.col("toxic").alias("label"),
                     (span_op.softmax_p1(l0, l1) >= 0.5).cast("int").alias("pred"))


@register("m3_guardrail_macro_f1")
def guardrail_f1(spark, sf):
    return met.macro_f1(_guardrail_preds(spark, sf))


@register("m4_entity_f1")
def entity_f1(spark, sf):
    """Entity F1 of an alternative detector set against the tagger's tags on the same tokens."""
    from ..functions import regex as rxx
    docs = _doc_frame(spark, sf)
    gold = span_op.texts_to_bio(docs, span_op.TAGGER_DETECTORS)
    alt = {"CARD": rxx.J_CARD, "PHONE": rxx.J_PHONE_LOOSE, "FIN": rxx.J_FIN_CALL}
    pred = span_op.texts_to_bio(docs, alt)
    return met.entity_f1(gold, pred)


@register("m4_entity_f1_ids")
def entity_f1_ids(spark, sf):
    """M4 on label ids: the same two taggings as id arrays, a position of -100 before and after each document."""
    from ..functions import regex as rxx
    docs = _doc_frame(spark, sf)
    alt = {"CARD": rxx.J_CARD, "PHONE": rxx.J_PHONE_LOOSE, "FIN": rxx.J_FIN_CALL}
    tagged = span_op.tagged_texts(docs, gold=span_op.TAGGER_DETECTORS, pred=alt)
    wid = F.concat(F.array(F.lit(None).cast("int")), F.transform("pieces", lambda _, i: i), F.array(F.lit(None).cast("int")))
    tagged = tagged.select("row", *(span_op.all_tags(n).alias(n) for n in ("gold", "pred")), wid.alias("wid")).where(F.size("wid") > 2)
    both = tagged.select("row", *(mdl.align_labels(F.col("wid"), F.col(n)).alias(n) for n in ("gold", "pred")))
    return met.entity_f1_ids(both, "gold", "pred")


@register("m5_wer_turns")
def wer_turns(spark, sf):
    """Corpus WER of each turn against the previous turn of the same conversation."""
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    return met.wer(met.consecutive_pairs(c, "conv_id", ["turn"], "text"))


def _events(spark, sf):
    return read_table(spark, sf, "events", ["event_id", "ts", "event_type", "value"])


@register("m6_latency_means")
def latency_means(spark, sf):
    return met.latency_means(_events(spark, sf), "event_type", ["ts", "event_id"], "value", warmup=1)


@register("m8_speedups")
def speedups(spark, sf):
    return met.speedups(met.latency_means(_events(spark, sf), "event_type", ["ts", "event_id"], "value", 1),
                        "event_type", "click")


@register("m9_load_summary")
def load_summary(spark, sf):
    e = _events(spark, sf)
    return met.load_summary(e, "ts", "value", F.col("event_type") == "error")


@register("m11_conformance")
def conformance(spark, sf):
    return met.conformance(score_calls_long(spark, sf))


# ------------------------------------------------------------------ raw payload ingestion


def _payload_calls(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return call_src.normalize_payloads(call_src.payloads_from_conversations(conv))


@register("s6_payload_scores")
def payload_scores(spark, sf):
    """JSON payloads (derived per turn, mixed shapes) -> VARIANT normalisation -> long-form scores.

    The normalised segments are read by the scorer's split decision and by both of its branches:
    they are written once to the checkpoint folder instead of re-parsing the JSON each time."""
    from ..session import materialize
    calls, _ = _payload_calls(spark, sf)
    seg = materialize(call_src.segments_long(calls), "payload-segments")
    return rules.to_long(rules.score_calls(seg, TEST_LEXICON, role=AGENT_ROLE))


@register("r6n_score_whole_calls")
def score_whole_calls(spark, sf):
    """Whole-call payloads (one per conversation) scored row by row with array expressions (nested
    layout, no shuffle in the scoring itself); calls too large for one payload in long form. Every
    call has its five rows."""
    from ..operators.nested import score_nested
    whole, large = call_src.split_by_size(conv_segments(spark, sf))
    calls, _ = call_src.normalize_payloads(call_src.payloads_from_strings(call_src.payloads_per_call(whole), "value"))
    wide = score_nested(calls, TEST_LEXICON, role=AGENT_ROLE)
    return rules.to_long(wide.unionByName(rules.score_calls(large, TEST_LEXICON, role=AGENT_ROLE)))


def _broken(spark, sf):
    return call_src.normalize_payloads(call_src.broken_payloads(read_table(spark, sf, "conversations")), keep=("conv_id", "turn", "fault"))


@register("n1_payload_rejects")
def payload_rejects(spark, sf):
    """Payloads with faults derived by turn that are no call, with the reason."""
    return _broken(spark, sf)[1].select("conv_id", "turn", "reason")


@register("n3_broken_segments")
def broken_segments(spark, sf):
    """The segments of the others: dropped elements, odd speakers and texts, swapped, garbage, null and missing times."""
    calls, _ = _broken(spark, sf)
    return calls.select("conv_id", "turn", "fault", "call_id", "n_dropped", "n_blank", F.inline("segments"))


@register("n7_call_profile")
def call_profile(spark, sf):
    return segments.call_profile(conv_segments(spark, sf), role=AGENT_ROLE)


# ------------------------------------------------------------------ event-time windows (batch form of the streams)


def _timed_events(spark, sf):
    return read_table(spark, sf, "events", ["user_id", "ts", "event_type", "value"]).withColumn("ts", F.col("ts").cast("timestamp"))


@register("t3_silence_sessions")
def silence_sessions(spark, sf):
    """Sessions of every user, a new one after 60 s of silence, with the silence before it."""
    s = jobs.silence_sessions(_timed_events(spark, sf), "user_id", "ts").drop("s")
    gaps = jobs.silence_gaps(s, "user_id").select("user_id", F.col("silence_to").alias("first_ts"), "silence_from")
    out = s.join(gaps, ["user_id", "first_ts"], "left")
    return out.select("user_id", F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"), "n_events",
                      (F.unix_micros("first_ts") - F.unix_micros("silence_from")).alias("silence_us"))


@register("t4_health_windows")
def health_windows(spark, sf):
    """T4: sliding windows of an hour, one each quarter of an hour."""
    w = jobs.health_windows(_timed_events(spark, sf), "ts", "value", F.col("event_type") == "error", "1 hour", "15 minutes")
    return w.select(F.unix_seconds("w.start").alias("start_s"), "n", F.round("fail_pct", 6).alias("fail_pct"), F.round("mean", 6).alias("mean"))


# ------------------------------------------------------------------ models and decoding

HEAD = mdl.linear_head_weights(64, 2)
CTC_VOCAB = ["_", "a", " ", "b", "c", "d", "e", "f"]


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings", ["vec_id", "embedding"])


@register("d10_linear_head_softmax")
def linear_head_softmax(spark, sf):
    """D10 + D11: native linear head over ``embeddings``, stable two-class softmax, threshold 0.5."""
    e = _emb(spark, sf)
    l0, l1 = mdl.linear_logits(F.col("embedding"), HEAD)
    p = span_op.softmax_p1(l0, l1)
    return e.select("vec_id", F.round(p, 6).alias("p_unsafe"), (p >= 0.5).alias("is_unsafe"))


@register("g3_batch_predict")
def batch_predict(spark, sf):
    """The same head through the pluggable Arrow-batched scorer (numpy backend)."""
    e = _emb(spark, sf)
    out = mdl.batch_predict(e, "embedding", mdl.numpy_linear_head(HEAD))
    return out.select("vec_id", F.round(F.get("prediction", 1), 6).alias("p_unsafe"))


@register("d12_token_labels")
def token_labels(spark, sf):
    """All scores of each embedding as tokens of 9 label scores (the last one has what is left) ->
    argmax -> label."""
    e = _emb(spark, sf)
    rows = mdl.frames("embedding", 9)
    tags = mdl.ids_to_labels(mdl.argmax_rows(rows))
    return e.select("vec_id", F.posexplode(tags).alias("t", "tag"))


@register("g5_ctc_decode")
def ctc_decode(spark, sf):
    """Each embedding as 8 frames x 8 symbol scores, greedy CTC decode with blank id 0."""
    e = _emb(spark, sf)
    ids = mdl.argmax_rows(mdl.frames("embedding", 8))
    return e.select("vec_id", mdl.ctc_greedy(ids, CTC_VOCAB, blank=0).alias("text"))


@register("g1_train_guardrail")
def train_guardrail(spark, sf):
    """G1 + G2 + M3: fit the TF-IDF/LR guardrail on the exact train split of documents x labels,
    score the validation split, report accuracy and macro-F1."""
    ld = _labelled_docs(spark, sf).select("doc_id", "text", F.col("toxic").alias("label"))
    split = corp.split_exact(ld, "doc_id", 0.2, SEED)
    model = mdl.train_guardrail(split.where("split = 'train'"))
    scored = mdl.score_guardrail(model, split.where("split = 'validation'"))
    return met.macro_f1(scored.select("label", F.col("is_unsafe").cast("int").alias("pred")))


# ------------------------------------------------------------------ LLM answers as tables

LLM_MODEL = "offline-batch-scorer"


@register("r9_llm_requests")
def llm_requests(spark, sf):
    """One prompt per call with the redacted transcript JSON; read back out of the prompt text
    (segments count, redacted characters) to check the embedding round trip."""
    req = llm_op.llm_requests(conv_segments(spark, sf), chunks=conv_chunks(spark, sf))
    body = F.regexp_extract("user", r"(?s)Transcript \(JSON\):\n(\{.*\})\n\nTask:", 1)
    parsed = F.from_json(body, "struct<call_id:string,segments:array<struct<speaker:string,text:string,start:double,end:double>>>")
    x = req.select(parsed.alias("t"), F.col("user").startswith("Transcript (JSON):").alias("templated"))
    parts = x.select(F.col("t.call_id").alias("call_id"), F.size("t.segments").alias("n"),
                     F.aggregate("t.segments", F.lit(0), lambda acc, sg: acc + F.length(sg["text"])).alias("chars"),
                     F.aggregate("t.segments", F.lit(0.0), lambda acc, sg: acc + sg["end"] - sg["start"]).alias("s"),
                     "templated")
    return parts.groupBy("call_id").agg(
        F.sum("n").alias("n_segments"), F.sum("chars").cast("int").alias("redacted_chars"), F.sum("s").alias("talk_s"),
        F.bool_and("templated").alias("templated"))


def _validated(spark, sf):
    from ..session import cut_lineage
    seg = conv_segments(spark, sf)
    # read by the answer derivation and by the merge: materialise once in the checkpoint folder
    wide = cut_lineage(rules.score_calls(seg, TEST_LEXICON, role=AGENT_ROLE, chunks=conv_chunks(spark, sf)))
    answers = llm_op.answers_from_rules(rules.to_long(wide), seg, AGENT_ROLE)
    return seg, wide, llm_op.validate_answers(llm_op.parse_answers(answers), seg, chunks=conv_chunks(spark, sf))


@register("r11_llm_validation")
def llm_validation(spark, sf):
    _, _, v = _validated(spark, sf)
    return v.select("call_id", "valid")


@register("r12_llm_merge")
def llm_merge(spark, sf):
    _, wide, v = _validated(spark, sf)
    merged = llm_op.merge_scores(wide, v, LLM_MODEL)
    return rules.to_long(merged).join(merged.select("call_id", "llm_used"), "call_id")


# ------------------------------------------------------------------ files, BIO corpora


def _bio_rows(spark, sf):
    """Every document with its regex entity spans (an empty array where it has none), converted to BIO rows."""
    spans = F.transform("entities", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), x["label"].alias("label")))
    corpus = span_op.with_entities(_doc_frame(spark, sf)).select(
        "row", F.col("doc_id").alias("row_id"), "text", F.array_sort(spans).alias("entities"))
    return bio_op.spans_corpus_to_bio(corpus)


@register("b4_spans_to_bio_rows")
def spans_to_bio_rows(spark, sf):
    """Documents with their regex entity spans as a span-annotated corpus, converted to BIO rows."""
    return _bio_rows(spark, sf).select("row_id", F.size("tokens").alias("n_tokens"),
                                       F.size(F.filter("tags", lambda t: t != "O")).alias("n_tagged"),
                                       F.array_join(F.filter("tags", lambda t: t != "O"), " ").alias("tag_seq"))


@register("b11_align_labels")
def align_labels(spark, sf):
    """B11 on the BIO rows of b4: the label of every sub-word piece (4-character pieces, special tokens -100)."""
    rows = _bio_rows(spark, sf).withColumn("wid", bio_op.subword_ids(F.col("tokens")))
    return rows.select("row_id", F.posexplode(mdl.align_labels(F.col("wid"), F.col("tags"))).alias("i", "label_id"))


@register("l12_explore_candidates")
def explore_candidates(spark, sf):
    """L12 over all documents: sentences (10..240, ellipsis enders), how many look like PII, and the
    first five flagged ones in document order (a top-5 report)."""
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    s = sent_op.sentences(d, "doc_id", "text", 10, 240, enders=".!?…")
    flag = pii_fn.looks_like("sentence", "explore")
    first5 = s.where(flag).orderBy("doc_id", "sent_no").limit(5)
    counts = s.agg(F.count(F.lit(1)).alias("n_sentences"), F.count_if(flag).alias("n_flagged"))
    summary = counts.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("sent_no"),
                            F.lit(None).cast("string").alias("sentence"), "n_sentences", "n_flagged")
    examples = first5.select("doc_id", "sent_no", "sentence", F.lit(None).cast("long").alias("n_sentences"),
                             F.lit(None).cast("long").alias("n_flagged"))
    return summary.unionByName(examples)


@register("k4_results_json")
def results_json(spark, sf):
    """K4: scoring response records as JSON (results keyed by metric), read back with a typed schema."""
    wide = rules.score_calls(conv_segments(spark, sf, numeric_id=True), TEST_LEXICON, role=AGENT_ROLE,
                             chunks=conv_chunks(spark, sf))
    schema = ("struct<dataset_id:string,call_id:string,results:map<string,"
              "struct<score:int,probability:string,reasoning:string,evidence_snippet:string>>>")
    back = rules.results_json(wide).select(F.from_json("json", schema).alias("r"))
    return back.select("r.call_id", F.explode("r.results").alias("metric", "x")).select(
        "call_id", "metric", "x.score", "x.probability", "x.reasoning", "x.evidence_snippet")
