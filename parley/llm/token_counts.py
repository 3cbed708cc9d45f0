"""Operator 2: token counts attributed to sections by character offsets.

A document is encoded once, as a whole, so tokens that straddle a section boundary are counted as
they really occur in training. Every token gets the span of the characters whose bytes it covers;
spans are interval-joined to the sections by binary search, and a token that touches more than one
section goes where ``rule`` says:

* ``majority``: to the section holding most of its characters, the earlier one on a tie;
* ``first`` / ``last``: to the section of its first / last character;
* ``split``: in equal parts of its characters (fractions add up to the token).

Sections default to the lines of the text, each with its line break, so they tile the text. Other
sections come as an ``array<struct<start:int,end:int>>`` column, sorted and disjoint, in characters;
tokens outside all of them are reported under section -1.

Defined results: a null or empty text has one empty section with 0 tokens; repeated rows are counted
each; sections of zero length get 0 tokens; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, VOCAB, codec
from .common import blocks, texts_of

RULES = ("majority", "first", "last", "split")


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines, line breaks included; one empty section for an empty text."""
    cuts, at = [0], text.find("\n")
    while at >= 0:
        cuts.append(at + 1)
        at = text.find("\n", at + 1)
    if cuts[-1] != len(text) or len(cuts) == 1:
        cuts.append(len(text))
    return np.array(cuts[:-1], dtype=np.int64), np.array(cuts[1:], dtype=np.int64)


def token_spans(text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character span of each token from the tokens' byte sizes (characters whose bytes it covers)."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char_of[starts], char_of[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, sec_lo: np.ndarray, sec_hi: np.ndarray,
              rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens and crossing tokens per section, and the tokens (or parts) outside every section."""
    n = len(sec_lo)
    counts, crossing = np.zeros(n), np.zeros(n, dtype=np.int64)
    if not len(starts) or not n:
        return counts, crossing, float(len(starts))
    a = np.searchsorted(sec_hi, starts, side="right")  # first section that ends after the token's start
    b = np.searchsorted(sec_lo, ends, side="left") - 1  # last section that starts before its end
    inside = (a == b) & (starts >= sec_lo[np.minimum(a, n - 1)]) & (ends <= sec_hi[np.minimum(a, n - 1)])
    counts += np.bincount(a[inside], minlength=n)[:n]
    outside = 0.0
    for s, e, i, j in zip(starts[~inside].tolist(), ends[~inside].tolist(), a[~inside].tolist(), b[~inside].tolist()):
        over = [(k, min(e, int(sec_hi[k])) - max(s, int(sec_lo[k]))) for k in range(i, j + 1)]
        over = [(k, w) for k, w in over if w > 0]
        for k, _ in over:
            crossing[k] += 1
        if rule == "split":
            for k, w in over:
                counts[k] += w / (e - s)
            outside += 1 - sum(w for _, w in over) / (e - s)
            continue
        gap = (e - s) - sum(w for _, w in over)
        if rule == "majority":
            k, w = max(over, key=lambda x: (x[1], -x[0]), default=(-1, 0))
            k = k if w >= gap else -1
        else:
            char = s if rule == "first" else e - 1
            k = next((k for k, _ in over if sec_lo[k] <= char < sec_hi[k]), -1)
        if k < 0:
            outside += 1
        else:
            counts[k] += 1
    return counts, crossing, outside


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None,
                 rule: str = "majority", vocab: str = VOCAB, pattern: str = PATTERN) -> DataFrame:
    """One row per document and section: ``section`` (from 0; -1 for tokens outside all), ``start``,
    ``end`` (characters), ``n_tokens`` (fractional only under ``split``), ``n_crossing``. No shuffle."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = codec(vocab, pattern)
        for b in blocks(batches, "text"):
            texts = texts_of(b)
            given = b.column("sections").to_pylist() if sections_col else [None] * len(texts)
            rows, sec, lo_all, hi_all, cnt, cross = [], [], [], [], [], []
            for row, (text, ids, own) in enumerate(zip(texts, c.encode_many(texts), given)):
                starts, ends = token_spans(text, c.sizes[np.frombuffer(ids, dtype="<u4")])
                if sections_col:
                    own = own or []
                    lo = np.array([x["start"] for x in own], dtype=np.int64)
                    hi = np.array([x["end"] for x in own], dtype=np.int64)
                else:
                    lo, hi = line_sections(text)
                n, x, out = attribute(starts, ends, lo, hi, rule)
                number = np.arange(len(lo))
                if out > 1e-9 or not len(lo):
                    number, lo, hi = np.append(number, -1), np.append(lo, 0), np.append(hi, 0)
                    n, x = np.append(n, out), np.append(x, 0)
                rows.append(np.full(len(number), row))
                sec.append(number)
                lo_all.append(lo)
                hi_all.append(hi)
                cnt.append(n)
                cross.append(x)
            cat = np.concatenate
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id").take(pa.array(cat(rows))), "section": pa.array(cat(sec).astype(np.int64)),
                "start": pa.array(cat(lo_all).astype(np.int64)), "end": pa.array(cat(hi_all).astype(np.int64)),
                "n_tokens": pa.array(cat(cnt).astype(np.float64)), "n_crossing": pa.array(cat(cross).astype(np.int64))})

    cols = [docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")]
    if sections_col:
        cols.append(docs[sections_col].alias("sections"))
    out = docs.select(*cols).mapInArrow(
        run, f"id {id_type}, section bigint, start bigint, end bigint, n_tokens double, n_crossing bigint")
    if rule != "split":
        out = out.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
    return out.withColumnRenamed("id", id_col)
