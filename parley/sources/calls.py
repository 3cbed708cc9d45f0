"""Raw call payloads -> normalised calls (S1, S2, S6, N1-N8), on Spark's VARIANT type.

Payloads are messy JSON: ``{call_id, segments}`` or ``{dataset_id, input: {...}}``; segments may be
non-objects, use ``start``/``start_time`` aliases, carry numbers as strings, nulls or garbage. A typed
``from_json`` nulls a whole array when one element does not fit, so payloads are parsed as VARIANT
and every field is read by path with presence tests. Each payload is one row; normalisation is a
per-row projection (no shuffle). Bad payloads go to a rejects output with a reason instead of an
exception.

Normalised segment: ``struct<pos INT, speaker STRING, text STRING, start DOUBLE, end DOUBLE, blank BOOLEAN>``
sorted by (start, end, pos).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_or_broken, py_strip
from ..session import cut_lineage

SEGMENT_TYPE = "struct<pos:int,speaker:string,text:string,start:double,end:double,blank:boolean>"


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2-style JSONL scan: one payload per line, parsed to VARIANT (splittable)."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.parse_json("value").alias("v"))


def read_payload_array(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array file of payloads (``multiLine``; such a file is read by one task, prefer JSONL)."""
    arr = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    return arr.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))


def payloads_from_strings(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.try_parse_json(F.col(col)).alias("v"))


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_obj(v: Column) -> Column:
    return F.coalesce(_vtype(v).startswith("OBJECT"), F.lit(False))


def _get(v: Column, name: str) -> Column:
    """Value of key ``name`` as VARIANT: SQL NULL when absent, a variant null for JSON null."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


_JSON_PARTS = r'"(?:[^"\\]|\\.)*"|[^",:\[\]{}\s]+|[,:\[\]{}]'


def py_container(json: Column) -> Column:
    """A JSON list or object as Python writes it: ``['a', 1]``, ``{'k': None}`` (keys in the order of ``json``; a VARIANT
    keeps them sorted). Strings are quoted as Python does, with backslashes, quotes and line breaks escaped."""
    def part(p):
        s = F.get(F.from_json(F.concat(F.lit("["), p, F.lit("]")), "array<string>"), 0)
        esc = F.replace(F.replace(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")),
                        F.lit("\t"), F.lit("\\t"))
        double = s.contains("'") & ~s.contains('"')
        text = F.when(double, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
        return (F.when(p.startswith('"'), text).when(p == "true", F.lit("True")).when(p == "false", F.lit("False"))
                .when(p == "null", F.lit("None")).when(p == ",", F.lit(", ")).when(p == ":", F.lit(": ")).otherwise(p))
    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(_JSON_PARTS), 0), part), "")


def _py_str_or_empty(x: Column) -> Column:
    """``str(x or "")`` for a VARIANT field: missing/null/false/0/''/[]/{} -> '', strings as is,
    true -> 'True', other numbers in Python's ``str`` form, lists and objects as Python writes them."""
    t = _vtype(x)
    s = F.try_variant_get(x, "$", "string")
    d = F.try_variant_get(x, "$", "double")
    return (F.when(x.isNull() | F.is_variant_null(x), F.lit(""))
            .when(t == "STRING", s)
            .when(t == "BOOLEAN", F.when(s == "true", F.lit("True")).otherwise(F.lit("")))
            .when(t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
                  F.when(d == 0, F.lit("")).otherwise(d.cast("string")))
            .when(d == 0, F.lit(""))
            .when(t.startswith("ARRAY") | t.startswith("OBJECT"),
                  F.when(F.to_json(x).isin("[]", "{}"), F.lit("")).otherwise(py_container(F.to_json(x))))
            .otherwise(F.coalesce(s, F.to_json(x))))


def _py_float(x: Column) -> Column:
    """Python ``float(x)``: numbers, booleans and numeric strings; null/objects -> NULL (failure)."""
    return F.when(F.is_variant_null(x), F.lit(None).cast("double")).otherwise(F.try_variant_get(x, "$", "double"))


def unwrap(v: Column) -> tuple[Column, Column]:
    """The ``input`` object when present, else the payload; and the echoed ``dataset_id``."""
    inner = _get(v, "input")
    body = F.when(_is_obj(inner), inner).otherwise(v)
    ds = F.try_variant_get(v, "$.dataset_id", "string")
    return body, ds


def _segment(x: Column, i: Column) -> Column:
    start_raw = F.coalesce(_get(x, "start"), _get(x, "start_time"))
    end_raw = F.coalesce(_get(x, "end"), _get(x, "end_time"))
    s = F.when(start_raw.isNull(), F.lit(0.0)).otherwise(_py_float(start_raw))
    e = F.when(end_raw.isNull(), F.lit(0.0)).otherwise(_py_float(end_raw))
    bad = s.isNull() | e.isNull()
    s0 = F.when(bad, F.lit(0.0)).otherwise(s)
    e0 = F.when(bad, F.lit(0.0)).otherwise(e)
    swap = ~F.isnan(s0) & ~F.isnan(e0) & (e0 < s0)
    text = _py_str_or_empty(_get(x, "text"))
    return F.struct(i.cast("int").alias("pos"), py_strip(_py_str_or_empty(_get(x, "speaker"))).alias("speaker"),
                    text.alias("text"),
                    F.when(swap, e0).otherwise(s0).alias("start"), F.when(swap, s0).otherwise(e0).alias("end"),
                    blank_or_broken(text).alias("blank"))


def normalize_payloads(payloads: DataFrame, v: str = "v", keep=()) -> tuple[DataFrame, DataFrame]:
    """N1-N8 (+S6): ``(calls, rejects)``.

    calls: ``call_id, dataset_id, segments ARRAY<SEGMENT_TYPE>, n_dropped, n_blank``;
    rejects: ``payload (JSON text), reason``. Both keep the columns of ``keep``.
    """
    raw = F.col(v)
    body, ds = unwrap(raw)
    cid_v = _get(body, "call_id")
    cid = F.try_variant_get(cid_v, "$", "string")
    segs_v = _get(body, "segments")
    ok_id = (_vtype(cid_v) == "STRING") & (F.coalesce(cid, F.lit("")) != "")
    ok_segs = F.coalesce(_vtype(segs_v).startswith("ARRAY"), F.lit(False))
    reason = (F.when(~_is_obj(body), F.lit("payload is not an object"))
              .when(~ok_id, F.lit("Missing or invalid call_id"))
              .when(~ok_segs, F.lit("Missing or invalid segments list")))
    x = payloads.select(*keep, raw.alias("_v"), body.alias("_b"), ds.alias("dataset_id"), cid.alias("call_id"),
                        F.try_variant_get(segs_v, "$", "array<variant>").alias("_arr"), reason.alias("reason"))
    rejects = x.where(F.col("reason").isNotNull()).select(*keep, F.to_json("_v").alias("payload"), "reason")
    good = x.where(F.col("reason").isNull())
    indexed = F.transform("_arr", lambda el, i: F.struct(el.alias("x"), i.alias("i")))
    objs = F.filter(indexed, lambda p: _is_obj(p["x"]))
    segs = F.transform(objs, lambda p: _segment(p["x"], p["i"]))
    key = F.transform(segs, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["pos"].alias("c"), s.alias("s")))
    ordered = F.transform(F.array_sort(key), lambda k: k["s"])
    calls = good.select(*keep, "call_id", "dataset_id", ordered.alias("segments"),
                        (F.size("_arr") - F.size(objs)).alias("n_dropped"))
    calls = calls.withColumn("n_blank", F.size(F.filter("segments", lambda s: s["blank"])))
    return calls, rejects


def effective_call_id(payload: Column) -> Column:
    """``input.call_id``, else top-level ``call_id``, else ``UNKNOWN_CALL_ID`` (empty counts as missing)."""
    a = F.try_variant_get(payload, "$.input.call_id", "string")
    b = F.try_variant_get(payload, "$.call_id", "string")
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")), F.lit("UNKNOWN_CALL_ID"))


def segments_long(calls: DataFrame) -> DataFrame:
    """N11 nested -> long for scoring: ``call_id, pos, speaker, text, start, end``."""
    return calls.select("call_id", F.inline("segments")).drop("blank")


def payloads_from_conversations(conversations: DataFrame) -> DataFrame:
    """Payload JSON derived from the ``conversations`` table, one payload per turn (a call's turns
    arrive in separate payloads; the long-form scorer regroups them). Shapes vary by turn so every
    normalisation path is exercised: wrapped ``{dataset_id, input}`` every third conversation,
    ``start_time``/``end_time`` aliases on odd turns, times as strings when the turn is divisible by 4.
    """
    from ..operators.segments import derive_times
    t = derive_times(conversations)
    s_sec, e_sec = F.col("start_ms") / 1000.0, F.col("end_ms") / 1000.0
    plain = F.to_json(F.struct(F.col("role").alias("speaker"), "text", s_sec.alias("start"), e_sec.alias("end")))
    alias = F.to_json(F.struct(F.col("role").alias("speaker"), "text", s_sec.alias("start_time"),
                               e_sec.alias("end_time")))
    texty = F.to_json(F.struct(F.col("role").alias("speaker"), "text", s_sec.cast("string").alias("start"),
                               e_sec.cast("string").alias("end")))
    seg = (F.when(F.col("turn") % 4 == 0, texty).when(F.col("turn") % 2 == 1, alias).otherwise(plain))
    inner = F.concat(F.lit('{"call_id":"'), F.col("conv_id").cast("string"), F.lit('","segments":['), seg, F.lit("]}"))
    wrapped = F.concat(F.lit('{"dataset_id":"ds-'), F.col("conv_id").cast("string"), F.lit('","input":'), inner,
                       F.lit("}"))
    js = F.when(F.col("conv_id") % 3 == 0, wrapped).otherwise(inner)
    return t.select(F.parse_json(js).alias("v"))


def broken_payloads(conversations: DataFrame) -> DataFrame:
    """One payload per turn with the faults that messy logs hold (``conv_id, turn, fault, v``), derived from the
    ``conversations`` table: ``fault`` = (conv_id + turn) % 14.

    0 no object; 1 no call id, 2 a number, 3 empty; 4 no segments, 5 an object; 6 elements that are no objects;
    7 swapped times; 8 a time that is no number; 9 a null time beside its alias; 10 no times at all; 11 containers as speaker and
    text; 12 a boolean speaker and a null text; 13 sound.
    """
    from ..operators.segments import derive_times
    t = derive_times(conversations).withColumn("fault", ((F.col("conv_id") + F.col("turn")) % 14).cast("int"))
    f, lit = F.col("fault"), F.lit
    string = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    start, end = ((F.col(c) / 1000.0).cast("string") for c in ("start_ms", "end_ms"))
    times = (F.when(f == 7, F.concat(lit('"start":'), end, lit(',"end":'), start))
             .when(f == 8, F.concat(lit('"start":"soon","end":'), end))
             .when(f == 9, F.concat(lit('"start":null,"start_time":'), start, lit(',"end":'), end))
             .when(f == 10, lit('"note":1'))
             .otherwise(F.concat(lit('"start_time":"'), start, lit('","end":'), end)))
    who = (F.when(f == 11, lit("""["a",1,null,{"k":"it's"}]""")).when(f == 12, lit("true")).otherwise(string(F.col("role"))))
    text = F.when(f == 11, lit("{}")).when(f == 12, lit("null")).otherwise(string(F.coalesce("text", lit(""))))
    seg = F.concat(lit('{"speaker":'), who, lit(',"text":'), text, lit(","), times, lit("}"))
    call = (F.when(f == 1, lit("")).when(f == 2, lit('"call_id":17,')).when(f == 3, lit('"call_id":"",'))
            .otherwise(F.concat(lit('"call_id":"'), F.col("conv_id").cast("string"), lit('",'))))
    segs = (F.when(f == 4, lit('"other":[]')).when(f == 5, F.concat(lit('"segments":'), seg))
            .when(f == 6, F.concat(lit('"segments":[5,'), seg, lit(',"x",null]'))).otherwise(F.concat(lit('"segments":['), seg, lit("]"))))
    js = F.when(f == 0, F.concat(lit("["), seg, lit("]"))).otherwise(F.concat(lit("{"), call, segs, lit("}")))
    return t.select("conv_id", "turn", "fault", F.parse_json(js).alias("v"))


def split_by_size(segments: DataFrame, max_chars: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """``(segments of calls a payload may hold whole, segments of larger calls)``; together all rows.

    The sizes come from a partial aggregate; they are checkpointed, so both joins below are between plain
    shuffles, which AQE can split when a call holds a large share of the rows.
    """
    large = cut_lineage(segments.groupBy("call_id").agg(F.sum(F.length("text")).alias("chars"))
                        .where(F.col("chars") > max_chars).select("call_id"))
    return segments.join(large, "call_id", "left_anti"), segments.join(large, "call_id", "left_semi")


def payloads_per_call(segments: DataFrame) -> DataFrame:
    """One complete-transcript payload per call, ``{call_id, segments: [...]}`` as JSON text.

    A payload carries a whole call, as the service contract does; ``split_by_size`` first, where calls can
    be of any size, and score the larger ones in long form.
    """
    s = F.struct(F.col("start").alias("_a"), F.col("end").alias("_b"), F.col("pos").alias("_c"),
                 F.struct("speaker", "text", "start", "end").alias("seg"))
    per = segments.groupBy("call_id").agg(F.array_sort(F.collect_list(s)).alias("_s"))
    body = F.struct(F.col("call_id").cast("string").alias("call_id"),
                    F.transform("_s", lambda x: x["seg"]).alias("segments"))
    return per.select(F.to_json(body).alias("value"))


def expected_scores(payloads: DataFrame, v: str = "v", metrics=("KR2.1", "KR2.2", "KR2.3", "KR2.4", "KR2.5"),
                    keep=()) -> DataFrame:
    """Labelled items ``{input, expected_output: {KR2.x: {score}}}`` unpivoted to
    ``call_id, metric, score`` (N18 call id; a missing or non-integer expected score stays NULL)."""
    raw = F.col(v)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"),
                              F.try_variant_get(raw, f"$.expected_output['{m}'].score", "int").alias("score"))
                     for m in metrics])
    return payloads.select(*keep, effective_call_id(raw).alias("call_id"), F.explode(rows).alias("x")).select(
        *keep, "call_id", "x.metric", "x.score")
