"""Operator 5: license scan of short notices, exact phrases and bounded-error matches.

Words are maximal runs of ASCII digits, letters and non-ASCII characters of the text with A-Z
lower-cased. Base phrases count where their words stand consecutively. Notices are searched with up to
``errors`` character edits in the text's words joined by single spaces:

1. pigeonhole: a notice is split into ``errors`` + 2 pieces; whatever the edits, two pieces stay intact and
   shift against each other by ``errors`` at most, so a multi-pattern search for such pairs of pieces
   finds every possible place;
2. verify: around such a pair the notice can only lie in a window of its own length plus the edits on
   either side; windows with too few of its 3-grams to hold it go, the ``regex`` library matches it there with bounded errors (``{e<=0}``, ``{e<=1}``, ... up to the limit, so that the best match wins).

A notice's score is 1 - edits / length; the row's score is the highest of its notices (1 for a base
phrase), 0 without any.

Defined results: null and empty texts have no words, no labels and score 0; overlapping places of a
base phrase are all counted; of overlapping matches of one notice the fewest edits stay (then the
earlier); texts are scanned whole; only the id and text columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import blocks, lower_ascii, texts_of

#: fixed values: base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: short notices in normalised words, label -> notices
NOTICES = {
    "apache-2.0": ["licensed under the apache license version 2 0"],
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person"],
    "cc-by": ["licensed under a creative commons attribution"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "gpl": ["this work is licensed under the gnu general public license version 3"],
    "bsd": ["redistribution and use in source and binary forms"],
    "mpl-2.0": ["subject to the terms of the mozilla public license"],
    "reserved": ["no part of this publication may be reproduced"],
}
ERROR_SHARE = 0.12

_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_words, _word_spans = _WORD.findall, _WORD.finditer


@dataclass(frozen=True)
class Hit:
    label: str
    start: int  # characters of the text
    end: int
    first_word: int
    edits: int
    score: float


def allowed_errors(notice: str, share: float = ERROR_SHARE) -> int:
    return max(1, int(len(notice) * share))


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors`` + 2 parts of nearly equal length."""
    n, k = len(notice), errors + 2
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, list[str]] = NOTICES, share: float = ERROR_SHARE):
        self.base = [(f" {p} ", label) for p, label in base.items()]
        self.notices, self._seeds = [], ahocorasick.Automaton()
        by_piece: dict[str, list] = {}
        for label, texts in notices.items():
            for notice in texts:
                k = allowed_errors(notice, share)
                number = len(self.notices)
                bounded = [regex.compile(f"(?:{regex.escape(notice)}){{e<={e}}}") for e in range(k + 1)]
                grams = [notice[i:i + 3] for i in range(len(notice) - 2)]
                self.notices.append((label, notice, k, bounded, grams))
                for at, piece in pieces(notice, k):
                    by_piece.setdefault(piece, []).append((number, at))
        for piece, places in by_piece.items():
            self._seeds.add_word(piece, (len(piece), places))
        self._seeds.make_automaton()

    def windows(self, joined: str) -> set[tuple[int, int, int]]:
        """(notice, lo, hi): stretches of the joined words that may hold a notice; every place is in one.

        Two pieces that agree on where the notice begins (within the errors) open a window around it.
        """
        out, recent = set(), {}
        for last, (size, places) in self._seeds.iter(joined):
            seed = last - size + 1
            for number, at in places:
                _, notice, k, _, _ = self.notices[number]
                line = seed - at  # where the notice would begin
                near = [(x, y) for x, y in recent.get(number, ()) if x >= seed - len(notice) - 2 * k]
                if any(y != at and abs(x - line) <= k for x, y in near):
                    out.add((number, max(0, line - 2 * k), line + len(notice) + 2 * k))
                near.append((line, at))
                recent[number] = near
        return out

    def matches(self, joined: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in the joined words; of overlapping ones of a notice the best."""
        found: dict[int, list] = {}
        for number, lo, hi in self.windows(joined):
            _, notice, k, bounded, grams = self.notices[number]
            window = joined[lo:hi]
            # an edit spoils three 3-grams at most
            if sum(g in window for g in grams) < len(grams) - 3 * k:
                continue
            # the bound rises from 0, so the first match has the fewest edits in the window
            m = next(filter(None, (p.search(window) for p in bounded)), None)
            if m:
                found.setdefault(number, []).append((lo + m.start(), lo + m.end(), sum(m.fuzzy_counts)))
        out = []
        for number, own in found.items():
            kept: list[tuple[int, int, int]] = []
            for hit in sorted(set(own)):
                if kept and hit[0] < kept[-1][1]:
                    if hit[2] < kept[-1][2]:
                        kept[-1] = hit
                else:
                    kept.append(hit)
            out += [(number, *hit) for hit in kept]
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[Hit]]:
        """(words, places of base phrases as (word, label), verified hits)."""
        text = lower_ascii(text)
        words = _words(text)
        joined = " ".join(words)
        padded = f" {joined} "
        places = []
        for spaced, label in self.base:
            at, seen, word = padded.find(spaced), 0, 0
            while at >= 0:
                word, seen = word + padded.count(" ", seen, at), at
                places.append((word, label))
                at = padded.find(spaced, at + 1)
        hits, spans, first, seen = [], None, 0, 0
        for start, end, edits, number in sorted((*m[1:], m[0]) for m in self.matches(joined)):
            label, notice, *_ = self.notices[number]
            spans = spans or [m.span() for m in _word_spans(text)]
            first, seen = first + joined.count(" ", seen, start), start
            last = first + joined.count(" ", start, max(start, end - 1))
            hits.append(Hit(label, spans[first][0], spans[min(last, len(spans) - 1)][1], first, edits, 1 - edits / len(notice)))
        return len(words), places, hits


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE,
         notices: dict[str, list[str]] = NOTICES, share: float = ERROR_SHARE) -> DataFrame:
    """One row per document: ``n_words``, ``n_base``, ``first_word``, ``last_word`` (starts of base places),
    ``base_labels``, ``labels`` (comma-joined), ``score`` and ``spans`` (label, start, end, edits). No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    spans = "array<struct<label:string,start:bigint,end:bigint,edits:int>>"
    span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))

    def run(batches):
        scanner = Scanner(base, notices, share)
        for b in blocks(batches, "text"):
            rows = []
            for text in texts_of(b):
                n, places, hits = scanner.scan(text)
                labels = {label for _, label in places}
                rows.append((n, len(places), min((w for w, _ in places), default=None), max((w for w, _ in places), default=None),
                             ",".join(sorted(labels)), ",".join(sorted(labels | {h.label for h in hits})),
                             1.0 if places else max((h.score for h in hits), default=0.0),
                             [{"label": h.label, "start": h.start, "end": h.end, "edits": h.edits} for h in hits]))
            n, nb, first, last, bl, al, score, sp = map(list, zip(*rows))
            i64 = pa.int64()
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "n_words": pa.array(n, i64), "n_base": pa.array(nb, i64),
                "first_word": pa.array(first, i64), "last_word": pa.array(last, i64), "base_labels": pa.array(bl, pa.string()),
                "labels": pa.array(al, pa.string()), "score": pa.array(score, pa.float64()), "spans": pa.array(sp, span_type)})

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, f"id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                               f"base_labels string, labels string, score double, spans {spans}").withColumnRenamed("id", id_col)
