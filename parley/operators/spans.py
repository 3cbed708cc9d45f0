"""Entities, BIO tags, spans, merging and masking (B3, D12-D17, G4), long form per text row.

Inputs come from ``tokens.doc_frame``, spread by row number. ``tagged_texts`` tags a text's tokens inside the row, with
entities that regex detectors find there or that a frame holds, so no token is shuffled or sorted. Windows and aggregates after it are
keyed by the row (plus finer keys) and run on the few tokens inside entities. ``entity_tags`` and ``entities_to_bio``
do the same for any frame of tokens, by a join on (row, block of characters).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pii
from ..functions import regex as rx
from .tokens import row_key, running_totals, token_columns, tokens_with_offsets, with_pieces, with_tokens, without_lead

# ---------------------------------------------------------------------------------------------
# The token label set (id order matters: ids index into it).
# ---------------------------------------------------------------------------------------------
LABELS = ["O", "B-FIN", "I-FIN", "B-CARD", "I-CARD", "B-PHONE", "I-PHONE", "B-PERSON", "I-PERSON"]
MASK = "****"
# ---------------------------------------------------------------------------------------------

# Regex detectors of the tagger (G4): exact formats by pattern, names by gazetteer.
TAGGER_DETECTORS = {"CARD": rx.J_CARD, "PHONE": rx.J_PHONE_STRICT, "FIN": rx.J_FIN_7}

SPAN_TYPE = "array<struct<label:string,s:int,e:int>>"


def _span(label: str):
    def span(size, end):
        return F.struct((end - size).alias("s"), end.alias("e"), F.lit(label).alias("label"))
    return span


def with_entities(docs: DataFrame, name: str = "entities", detectors: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with the spans that regex detectors find, an array of the row (``array<struct<s,e,eo,label>>``, ``eo`` =
    detection order).

    The pieces between matches (``split``) and the matches (``regexp_extract_all``) alternate, so a match ends at the
    running total of the lengths so far: linear in the number of matches, and nothing leaves the row.
    """
    det = detectors or TAGGER_DETECTORS
    text, lens, ends, found = F.coalesce("text", F.lit("")), {}, {}, []
    for d_i, (label, p) in enumerate(det.items()):
        lens[f"_gaps{d_i}"] = F.transform(F.split(text, p, -1), F.length)
        lens[f"_hits{d_i}"] = F.transform(F.regexp_extract_all(text, F.lit(p), 0), F.length)
        gaps, hits = F.col(f"_gaps{d_i}"), F.col(f"_hits{d_i}")
        ends[f"_ends{d_i}"] = running_totals(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, m: g + m), once=True)
        found.append(F.zip_with(hits, f"_ends{d_i}", _span(label)))
    spans = F.transform(F.concat(*found), lambda x, i: F.struct(x["s"].alias("s"), x["e"].alias("e"), i.cast("int").alias("eo"), x["label"].alias("label")))
    return docs.withColumns(lens).withColumns(ends).select(*docs.columns, spans.alias(name))


def regex_entities(docs: DataFrame, detectors: dict[str, str] | None = None) -> DataFrame:
    """Entity spans from regex detectors in long form: the row key, ``eo, label, s, e`` (``with_entities``)."""
    key = row_key(docs)
    x = with_entities(docs.select(*key, "text"), "found", detectors).select(*key, F.explode("found").alias("x"))
    return x.select(*key, "x.eo", "x.label", "x.s", "x.e")


#: between the tokens of a name, in no text token
_JOINT = "\u0001"


def name_table(names: DataFrame) -> DataFrame:
    """(``first``, ``name``, ``size``): names as their lower-case tokens joined, with the first one and their number."""
    from .tokens import PIECES, SPACE
    parts = F.filter(F.regexp_extract_all(F.lower(F.col(names.columns[0])), F.lit(PIECES), 0), lambda p: ~p.rlike(f"(?U)^[{SPACE}]"))
    x = names.select(parts.alias("p")).where(F.size("p") > 0)
    return x.select(F.get("p", 0).alias("first"), F.array_join("p", _JOINT).alias("name"), F.size("p").alias("size")).distinct()


def gazetteer_entities(tokens: DataFrame, names: DataFrame, label: str = "PERSON",
                       broadcast_max_rows: int = 1_000_000, max_tokens: int = 8) -> DataFrame:
    """Names of a list (first column; up to ``max_tokens`` tokens, case ignored) as entities (G4 person part).

    ``tokens``: texts (``doc_frame``), or a frame of their tokens. A token that begins a name is joined with the runs of
    tokens after it, one for each length that names have; the longest name at a token counts, and a name that begins
    inside an earlier one does not. In texts the tokens after it are a part of the row's array, so only tokens that
    begin a name leave the row; a frame of tokens is sorted for them. The name list is broadcast only after its row
    count is checked against ``broadcast_max_rows``; a larger one is joined by shuffles.
    """
    key = row_key(tokens)
    table = name_table(names)
    sizes = sorted(r["size"] for r in table.select("size").distinct().collect())  # one number for each length
    if sizes and sizes[-1] > max_tokens:
        raise ValueError(f"a name has {sizes[-1]} tokens; raise max_tokens ({max_tokens})")
    small = table.count() <= broadcast_max_rows
    side = F.broadcast if small else (lambda df: df)
    w = Window.partitionBy(key[0]).orderBy("ti")
    longest = sizes[-1] if sizes else 1
    if "text" in tokens.columns:
        x = with_tokens(tokens).select(*key, "pieces", "ends", F.transform("pieces", lambda p: F.lower(without_lead(p))).alias("words"))
        x = x.select(*key, F.posexplode(F.arrays_zip("pieces", "ends", F.col("words").alias("first"))).alias("ti", "x"), "words", "ends")
        after = [F.slice(c, F.col("ti") + 1, longest) for c in ("words", "ends")]
        t = x.select(*key, "ti", token_columns(F.col("x"))[1], "x.first", F.arrays_zip(after[0].alias("t"), after[1].alias("e")).alias("next"))
    else:
        t = tokens.select(*key, "ti", "s", "e", F.lower("token").alias("first"))
        follow = [F.struct(F.lead("first", i).over(w).alias("t"), F.lead("e", i).over(w).alias("e")) for i in range(1, longest)]
        t = t.withColumn("next", F.array(F.struct(F.col("first").alias("t"), F.col("e").alias("e")), *follow))
    t = t.join(side(table.select("first").distinct()), "first", "left_semi")
    runs = F.array(*[F.struct(F.lit(n).alias("size"), F.array_join(F.transform(F.slice("next", 1, n), lambda x: x["t"]), _JOINT).alias("name"),
                              F.get("next", n - 1)["e"].alias("end")) for n in sizes] or [F.struct(F.lit(0).alias("size"), F.lit("").alias("name"), F.lit(0).alias("end"))])
    x = t.select(*key, "ti", "s", F.explode(runs).alias("x")).select(*key, "ti", "s", "x.*").where(F.col("end").isNotNull())
    x = x.join(side(table.select("name", "size")), ["name", "size"], "left_semi").groupBy(*key, "ti", "s").agg(F.max("size").alias("size"), F.max("end").alias("e"))
    upto = F.max(F.col("ti") + F.col("size")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("upto", upto).where(F.col("upto").isNull() | (F.col("ti") >= F.col("upto")))
    return x.select(*key, (F.lit(1_000_000) + F.col("ti")).alias("eo"), F.lit(label).alias("label"), "s", "e")


#: characters of a block in the join of tokens and entities
BLOCK = 64


def _blocks(s: str, e: str) -> Column:
    """Blocks of characters that [s, e) touches; the block of ``s`` where it is empty."""
    return F.explode(F.sequence(F.floor(F.col(s) / BLOCK), F.floor((F.greatest(F.col(e) - 1, F.col(s))) / BLOCK)))


def overlaps(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """All pairs of a token and an entity of the same text row that overlap (``t.e > n.s`` and ``t.s < n.e``).

    Both sides are listed once for each block of characters they touch and joined on (row, block); a pair that
    meets in several blocks is taken in the one where its overlap begins.
    """
    key = row_key(tokens)
    t = tokens.select(*key, "ti", "token", "s", "e", _blocks("s", "e").alias("block"))
    n = entities.select(F.col(key[0]).alias("n_key"), F.col("eo").alias("n_eo"), F.upper("label").alias("n_label"), F.col("s").alias("n_s"),
                        F.col("e").alias("n_e"), _blocks("s", "e").alias("n_block"))
    met = t.join(n, (F.col(key[0]) == F.col("n_key")) & (F.col("block") == F.col("n_block")) & (F.col("e") > F.col("n_s"))
                 & (F.col("s") < F.col("n_e")) & (F.col("block") == F.floor(F.greatest("s", "n_s") / BLOCK)))
    return met.select(*key, "ti", "token", "s", "e", "n_eo", "n_label", "n_s", "n_e")


def entity_tags(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """The tokens inside entities: the row key, ``ti, token, s, e, tag``.

    B3: entities sorted by (start, end); tokens overlapping the half-open span get ``B-`` (first) then ``I-``; a later
    entity overwrites an earlier one.
    """
    key = row_key(tokens)
    pairs = overlaps(tokens, entities).repartition(key[0])  # what follows is keyed by the row
    pairs = pairs.withColumn("first_ti", F.min("ti").over(Window.partitionBy(key[0], "n_eo")))
    win = F.struct("n_label", (F.col("ti") == F.col("first_ti")).alias("is_first"))
    g = pairs.groupBy(*key, "ti", "token", "s", "e").agg(F.max_by(win, F.struct("n_s", "n_e", "n_eo")).alias("w"))
    tag = F.concat(F.when(F.col("w.is_first"), F.lit("B-")).otherwise(F.lit("I-")), F.col("w.n_label"))
    return g.select(*key, "ti", "token", "s", "e", tag.alias("tag"))


def texts_with(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold an entity (co-partitioned, no exchange)."""
    key = row_key(docs)[0]
    # grows with the data: a per-partition hash join, whatever the estimated size
    return docs.join(entities.select(key).distinct().hint("shuffle_hash"), key, "left_semi").select(*docs.columns)


def _tag_codes(lens: Column, words: Column, begins: Column, ends: Column) -> Column:
    """For each token of a text, up to the last one in an entity: k if it is the first of the k-th entity (from 1), -k if it
    is another of it, 0 outside. A later entity overwrites an earlier one. Tokens by the lengths of their pieces and of
    themselves; the tokens that an entity overlaps are a run, found by binary search."""
    def codes(lens: pa.Array, words: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for i, n in enumerate(pc.list_value_length(begins).to_pylist()):
            tags = np.zeros(0, np.int32)
            if n:
                stop = np.cumsum(lens[i].values.to_numpy(), dtype=np.int64)
                start = stop - words[i].values.to_numpy()
                first = np.searchsorted(stop, begins[i].values.to_numpy(), "right")
                after = np.searchsorted(start, ends[i].values.to_numpy(), "left")
                tags = np.zeros(after.max(), np.int32)
                for k, (a, b) in enumerate(zip(first.tolist(), after.tolist()), 1):
                    if a < b:
                        tags[a:b] = -k
                        tags[a] = k
            out.append(tags)
        bounds = np.cumsum([0] + [len(t) for t in out])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(out or [np.zeros(0, np.int32)]), pa.int32()))

    return F.arrow_udf(codes, "array<int>")(lens, words, begins, ends)


def tag_arrays(texts: DataFrame, names: list[str]) -> DataFrame:
    """B3 in the row. ``names``: columns with a text's entities (``array<struct<s,e,eo,label>>`` or null), each replaced
    by the tags of its tokens, an array that ends with the last token in an entity (``O`` after it). Adds ``pieces`` and
    ``ends``."""
    found = lambda n: F.coalesce(F.array_sort(F.filter(F.col(n), lambda x: x["s"].isNotNull() & x["e"].isNotNull())),
                                 F.array().cast("array<struct<s:int,e:int,eo:int,label:string>>"))
    rest = [c for c in texts.columns if c not in names]
    x = with_pieces(texts.select(*rest, *(found(n).alias(n) for n in names)))
    held = F.greatest(F.lit(0), *(F.size(n) for n in names)) > 0
    none = F.array().cast("array<int>")
    x = x.withColumn("held", F.when(held, F.col("lens")).otherwise(none)).withColumn(
        "words", F.when(held, F.transform("pieces", lambda p: F.length(without_lead(p)))).otherwise(none))
    codes = [_tag_codes(F.col("held"), F.col("words"), F.col(f"{n}.s"), F.col(f"{n}.e")).alias(f"_{n}") for n in names]
    x = x.select(*rest, "pieces", *names, running_totals(F.col("lens")).alias("ends"), *codes)

    def tags(n):
        def tag(c):
            label = F.upper(F.get(F.col(n), F.abs(c) - 1)["label"])
            return F.when(c == 0, F.lit("O")).otherwise(F.coalesce(F.concat(F.when(c > 0, F.lit("B-")).otherwise(F.lit("I-")), label), F.lit("O")))
        return F.transform(f"_{n}", tag).alias(n)
    return x.select(*rest, "pieces", "ends", *(tags(n) for n in names))


def all_tags(n: str) -> Column:
    """The tags of ``tag_arrays`` for every token."""
    return F.concat(F.col(n), F.array_repeat(F.lit("O"), F.size("pieces") - F.size(n)))


def tagged_texts(docs: DataFrame, **entities: DataFrame | dict[str, str]) -> DataFrame:
    """``docs`` with ``pieces``, ``ends`` and the tags of each set of entities (``tag_arrays``). Regex detectors find theirs in
    the text's row; a frame's entities become one array a text and meet the co-partitioned texts. Tokens stay in their row."""
    key = row_key(docs)[0]
    x = docs
    for name, ents in entities.items():
        if isinstance(ents, dict):
            x = with_entities(x, name, ents)
            continue
        per = ents.groupBy(F.col(key).alias(f"_{name}_row")).agg(
            F.collect_list(F.struct(*(F.col(c).cast("int").alias(c) for c in ("s", "e", "eo")), "label")).alias(name))
        # grows with the data: a per-partition hash join, whatever the estimated size
        x = x.join(per.hint("shuffle_hash"), F.col(key) == F.col(f"_{name}_row"), "left").drop(f"_{name}_row")
    return tag_arrays(x, list(entities))


def texts_to_bio(docs: DataFrame, entities: DataFrame | dict[str, str]) -> DataFrame:
    """B3 for every token of every text, with the entities of a frame or of regex detectors: the row key,
    ``ti, token, s, e, tag``."""
    return _tag_rows(tagged_texts(docs, tag=entities), row_key(docs))


def _tag_rows(tagged: DataFrame, key: list[str]) -> DataFrame:
    x = tagged.select(*key, F.posexplode(F.arrays_zip("pieces", "ends", "tag")).alias("ti", "x"))
    return x.select(*key, "ti", *token_columns(F.col("x")), F.coalesce("x.tag", F.lit("O")).alias("tag"))


def detected_tags(docs: DataFrame, detectors: dict[str, str] | None = None) -> DataFrame:
    """The tokens inside entities of the regex detectors; only texts with a match are cut into tokens."""
    key = row_key(docs)
    x = with_entities(docs.select(*key, "text"), "tag", detectors)
    x = x.withColumn("text", F.when(F.size("tag") > 0, F.col("text")).otherwise(F.lit("")))
    return _tag_rows(tag_arrays(x, ["tag"]), key).where("tag <> 'O'")


def entities_to_bio(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """B3 for every token: the row key, ``ti, token, s, e, tag``, with ``O`` outside entities."""
    key = row_key(tokens)
    hit = entity_tags(tokens, entities).select(F.col(key[0]).alias("n_key"), F.col("ti").alias("n_ti"), "tag").hint("shuffle_hash")
    out = tokens.join(hit, (F.col(key[0]) == F.col("n_key")) & (F.col("ti") == F.col("n_ti")), "left")
    return out.select(*key, "ti", "token", "s", "e", F.coalesce("tag", F.lit("O")).alias("tag"))


def bio_to_spans(tagged: DataFrame, tag_col: str = "tag", sparse: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """BIO tokens (the row key, ``ti, s, e, tag``) to spans ``label, s, e`` with the row key (and the columns ``by``,
    where a text has several taggings).

    Tokens with offsets (0, 0) are skipped. ``O`` closes the open span; ``B-x`` opens one; ``I-x``
    extends an open ``x`` span and otherwise opens a new one. As islands: a span starts at every
    non-``O`` token that is ``B-`` or whose predecessor's type differs; a running count of starts
    numbers the spans. ``sparse``: ``tagged`` has no ``O`` tokens (``entity_tags``); a gap in ``ti`` stands for them, and
    (0, 0) tokens that are left in it are no gap.
    """
    key = [*row_key(tagged), *by]
    group = [key[0], *by]
    skip = (F.col("s") == 0) & (F.col("e") == 0)
    x = tagged if sparse else tagged.where(~skip)
    w = Window.partitionBy(*group).orderBy("ti")
    typ = F.when((F.col(tag_col).startswith("B-") | F.col(tag_col).startswith("I-")) & ~skip, F.substring(tag_col, 3, 1 << 20))
    x = x.select(*key, "ti", "s", "e", F.col(tag_col).alias("tg"), typ.alias("typ"), skip.alias("skip"))
    if sparse:
        # the place among the tokens that are not skipped, and the last of those before
        x = x.withColumn("place", F.col("ti") - F.count_if("skip").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        last = F.last(F.when(~F.col("skip"), F.struct("place", "typ")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        x = x.withColumn("last", last)
        prev_typ = F.when(F.col("last.place") == F.col("place") - 1, F.col("last.typ"))
    else:
        prev_typ = F.lag("typ").over(w)
    start = F.col("typ").isNotNull() & (F.col("tg").startswith("B-") | prev_typ.isNull() | (prev_typ != F.col("typ")))
    x = x.withColumn("st", start.cast("int"))
    x = x.withColumn("span_no", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (x.where(F.col("typ").isNotNull()).groupBy(*key, "span_no")
            .agg(F.first("typ").alias("label"), F.min_by("s", "ti").alias("s"), F.max_by("e", "ti").alias("e"))
            .drop("span_no"))


def detected_spans(docs: DataFrame, detectors: dict[str, str] | None = None) -> DataFrame:
    """D13 over ``doc_frame`` rows with the regex detectors."""
    return bio_to_spans(detected_tags(docs, detectors), sparse=True)


def merge_spans(spans: DataFrame) -> DataFrame:
    """Sort by (s, e); a span joins the previous group when ``s <= max(e so far) + 1``; mixed labels
    become ``PII``. Running max over preceding rows replaces the sequential loop."""
    key = row_key(spans)
    w = Window.partitionBy(key[0]).orderBy("s", "e", "label")
    prev_max = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = spans.withColumn("new", (prev_max.isNull() | (F.col("s") > prev_max + 1)).cast("int"))
    x = x.withColumn("grp", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (x.groupBy(*key, "grp")
            .agg(F.when(F.count_distinct("label") > 1, F.lit("PII")).otherwise(F.first("label")).alias("label"),
                 F.min("s").alias("s"), F.max("e").alias("e"))
            .drop("grp"))


#: characters of the pieces that a text is cut into before parts of it are taken
PIECE = 2048


def _over_pieces(text: Column, spans: Column, fn) -> Column:
    """``fn(cut, spans)`` with ``cut(a, b)`` = characters a to b of the text.

    ``substring`` walks from the first character, so taking a part for each of many spans would cost spans x text. The
    text is cut into pieces once (the struct makes it a variable of the lambda) and a part is taken from its pieces.
    """
    def body(st):
        def cut(a, b):
            first = F.floor(a / PIECE).cast("int")
            some = F.slice(st["pieces"], first + 1, F.floor((F.greatest(b, a + 1) - 1) / PIECE).cast("int") - first + 1)
            return F.when(b > a, F.substring(F.array_join(some, ""), a - first * PIECE + 1, b - a)).otherwise(F.lit(""))
        return fn(cut, st["spans"])

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0)
    return F.get(F.transform(F.array(F.struct(pieces.alias("pieces"), spans.alias("spans"))), body), 0)


def mask_text(text: Column, spans: Column) -> Column:
    """Replace each span (sorted by start) by ``****`` and collapse runs of 4+ ``*``.

    Linear in the text: every output piece is ``text[prev.e : s] + '****'`` with ``prev`` the span
    before it, built independently by ``transform`` and joined once. Without spans the text is returned unchanged
    (no collapse).
    """
    def masked(cut, sps):
        def piece(sp, i):
            prev_e = F.when(i == 0, F.lit(0)).otherwise(F.get(sps, i - 1)["e"])
            return F.concat(cut(prev_e, sp["s"]), F.lit(MASK))
        return F.array_join(F.transform(sps, piece), "")

    last_e = F.get(spans, F.size(spans) - 1)["e"]
    raw = F.concat(_over_pieces(text, spans, masked), F.substring(text, last_e + 1, F.lit(1 << 30)))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) == 0, text).otherwise(F.regexp_replace(raw, rx.J_MULTI_STAR, MASK))


def span_texts(text: Column, spans: Column) -> Column:
    """D15 extracted entities: ``array<struct<label,text>>`` of the original text under each span."""
    def texts(cut, sps):
        return F.transform(sps, lambda sp: F.struct(sp["label"].alias("label"), cut(sp["s"], sp["e"]).alias("text")))

    none = F.array().cast("array<struct<label:string,text:string>>")
    return F.when(F.coalesce(F.size(spans), F.lit(0)) == 0, none).otherwise(_over_pieces(text, spans, texts))


def mask_documents(docs: DataFrame, merged: DataFrame) -> DataFrame:
    """D15 for every text: the columns of ``docs``, ``masked_text, entities`` (spans of a text are bounded by it)."""
    key = row_key(docs)[0]
    per = merged.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("s", "e", "label"))).alias("sp"))
    per = per.select(F.col(key).alias("n_key"), F.transform("sp", lambda x: F.struct(
        x["label"].alias("label"), x["s"].alias("s"), x["e"].alias("e"))).alias("spans"))
    j = docs.join(per.hint("shuffle_hash"), F.col(key) == F.col("n_key"), "left")  # per-row spans: co-partitioned, never broadcast
    sp = F.coalesce(F.col("spans"), F.array().cast(SPAN_TYPE))
    return j.select(*docs.columns, mask_text(F.col("text"), sp).alias("masked_text"), span_texts(F.col("text"), sp).alias("entities"))


def softmax_p1(logit0: Column, logit1: Column) -> Column:
    """Stable two-class softmax, probability of class 1."""
    m = F.greatest(logit0, logit1)
    a, b = F.exp(logit0 - m), F.exp(logit1 - m)
    return b / (a + b)


def regex_guardrail_logits(text: Column) -> tuple[Column, Column]:
    """A rule guardrail with two logits (safe 0, unsafe = detector hits - 0.5); used where no model is given."""
    hits = (pii.count(text, "card") + pii.count(text, "phone_strict") + pii.count(text, "fin7")
            + pii.count(text, "email"))
    return F.lit(0.0), hits.cast("double") - F.lit(0.5)


def cascade(docs: DataFrame, score: Column, threshold: float = 0.5, max_tokens: int | None = None,
            names: DataFrame | None = None, detectors: dict[str, str] | None = None,
            partitions: int | None = None, write_scores: bool = False) -> DataFrame:
    """D16 (+D11, D17): score every row; only rows with ``p >= threshold`` are tokenised, tagged,
    merged and masked; safe rows pass through untouched. Output
    ``doc_id, is_unsafe, guardrail_score, masked_text, entities, truncated``.

    ``score`` is a probability column over ``docs`` (e.g. ``softmax_p1`` of model logits).
    ``max_tokens`` inspects only the first tokens (flagged as ``truncated``).

    Safe rows go straight from the scan to the output; unsafe ones are spread by row number for the per-text
    steps. Both branches evaluate ``score``. With ``write_scores`` (a model that costs more than a copy of the texts, or
    whose scores may differ from run to run) scored rows are written once to the shared checkpoint folder,
    partitioned by ``is_unsafe``, and each branch reads its own partition.
    """
    from ..session import materialize
    from .tokens import doc_frame

    scored = (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), score.alias("guardrail_score"))
              .withColumn("is_unsafe", F.coalesce(F.col("guardrail_score") >= threshold, F.lit(False))))
    if write_scores:
        # partition values come back typed as numbers, not booleans: partition on a 0/1 copy
        scored = materialize(scored.withColumn("_u", F.col("is_unsafe").cast("int")), "cascade-scored", partition_by=["_u"])
        unsafe, safe = scored.where(F.col("_u") == 1), scored.where(F.col("_u") == 0)
    else:
        unsafe, safe = scored.where("is_unsafe"), scored.where("not is_unsafe")
    rows = doc_frame(unsafe.select(F.struct("doc_id", "guardrail_score").alias("doc"), "text"), "doc", "text", partitions)
    rows = rows.select("row", F.col("doc_id.doc_id").alias("doc_id"), "text", F.col("doc_id.guardrail_score").alias("guardrail_score"))
    truncated = F.lit(False)
    if max_tokens is None and names is None:
        inside = detected_tags(rows, detectors)
    elif max_tokens is None:
        ents = regex_entities(rows, detectors).unionByName(gazetteer_entities(rows.select("row", "doc_id", "text"), names))
        inside = texts_to_bio(texts_with(rows, ents), ents).where("tag <> 'O'")
    else:
        ents = regex_entities(rows, detectors)
        toks = tokens_with_offsets(rows)
        n_tok = toks.groupBy("row").agg(F.count(F.lit(1)).alias("n_tok"))
        rows = rows.join(n_tok.hint("shuffle_hash"), "row", "left")
        truncated = F.coalesce(F.col("n_tok") > max_tokens, F.lit(False))
        toks = toks.where(F.col("ti") < max_tokens)
        if names is not None:
            ents = ents.unionByName(gazetteer_entities(toks, names))
        inside = entity_tags(toks, ents)
    merged = merge_spans(bio_to_spans(inside, sparse=True))
    cols = ["doc_id", "is_unsafe", "guardrail_score", "masked_text", "entities", "truncated"]
    found = mask_documents(rows, merged).withColumn("truncated", truncated).withColumn("is_unsafe", F.lit(True))
    rest = safe.select("doc_id", "is_unsafe", "guardrail_score", F.col("text").alias("masked_text"),
                       F.array().cast("array<struct<label:string,text:string>>").alias("entities"), F.lit(False).alias("truncated"))
    return found.select(*cols).unionByName(rest.select(*cols))
