"""Operator 8: language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram's vector binds
its letters: the first rotated by two places, the second by one, multiplied together. A text's
profile bundles (adds up) the vectors of its trigrams; a language's prototype bundles the profiles
of its training texts. A text gets the language whose prototype has the largest cosine.

Texts are lower-cased; a run of characters that are no letters is one space, which has a vector of its
own, and every text begins and ends with one. Prototypes are sums of whole numbers, so they do
not depend on the order of the rows.

Defined results: null texts and texts without a letter get ``und`` and score 0, as do all when no
language was learned; equal cosines go to the first language by name; the score is the cosine, not
below 0; texts are read whole; only the named columns are read.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, texts_of

DIMENSIONS = 1024
SEED = 8
MAX_LANGUAGES = 1000
UNKNOWN = "und"
_CHUNK = 4096  # trigrams bound at once
_BLOCK = dict(max_bytes=500_000, max_rows=1000)


@dataclass(frozen=True)
class Prototypes:
    names: tuple[str, ...]
    vectors: np.ndarray  # languages x dimensions, unit length


_LETTER: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool))
    return _LETTER[0]


def letter_vectors(points: np.ndarray, dims: int) -> np.ndarray:
    """One row of +1 and -1 for each code point, the same in every task."""
    return np.stack([np.random.Generator(np.random.Philox(key=[SEED, int(p)])).integers(0, 2, dims, dtype=np.int8) * 2 - 1
                     for p in points]) if len(points) else np.zeros((0, dims), dtype=np.int8)


class Profiles:
    """Trigrams of a block of texts: row and number of each, and the bound vectors of the numbers."""

    def __init__(self, texts: list[str], dims: int, known: dict[int, np.ndarray]):
        self.dims, self.rows = dims, len(texts)
        spaced = [f" {t.lower()} " for t in texts]
        point = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in spaced])
        letter = is_letter()[point]
        self.has_letter = np.bincount(row[letter], minlength=len(texts)) > 0
        point = np.where(letter, point, 32)
        new_row = np.append(True, row[1:] != row[:-1])
        keep = letter | np.append(True, letter[:-1]) | new_row
        point, row = point[keep], row[keep]
        present = np.flatnonzero(np.bincount(point))
        rank = np.zeros(int(present[-1]) + 1, dtype=np.int64)
        rank[present] = np.arange(len(present))
        a = len(present)
        code = rank[point]
        tri = (code[:-2] * a + code[1:-1]) * a + code[2:]
        same = row[:-2] == row[2:]
        self.row, tri = row[:-2][same], tri[same]
        if a ** 3 <= 1 << 22:
            seen = np.flatnonzero(np.bincount(tri, minlength=1))
            number = np.zeros(a ** 3, dtype=np.int64)
            number[seen] = np.arange(len(seen))
            self.number = number[tri]
        else:
            seen, self.number = np.unique(tri, return_inverse=True)
        self.first, self.second, self.third = seen // (a * a), seen // a % a, seen % a
        fresh = [p for p in present.tolist() if p not in known]
        if len(known) + len(fresh) > 20_000:
            known.clear()
            fresh = present.tolist()
        known.update(zip(fresh, letter_vectors(np.array(fresh, dtype=np.int64), dims)))
        base = np.stack([known[p] for p in present.tolist()])
        self._base = base, np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)

    def bundle(self, group: np.ndarray, groups: int, kind) -> np.ndarray:
        """Sum of the trigram vectors by ``group`` (a number for each row)."""
        out = np.zeros((groups, self.dims), dtype=kind)
        total = len(self.first)
        cells = np.bincount(group[self.row] * total + self.number, minlength=groups * total).reshape(groups, total)
        b0, b1, b2 = self._base
        for c in range(0, total, _CHUNK):
            s = slice(c, c + _CHUNK)
            bound = b2[self.first[s]] * b1[self.second[s]] * b0[self.third[s]]
            out += cells[:, s].astype(kind) @ bound.astype(kind)
        return out


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text", dims: int = DIMENSIONS) -> Prototypes:
    """Prototypes of the labels of all rows with a non-null label.

    Each task adds up one vector a language; Spark adds those up by place.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        known: dict[int, np.ndarray] = {}
        for b in blocks(batches, "text", **_BLOCK):
            names, group = np.unique(np.array(b.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)
            found = Profiles(texts_of(b), dims, known).bundle(group, len(names), np.float64)
            for name, v in zip(names.tolist(), found):
                sums[name] = sums[name] + v if name in sums else v
        if sums:
            yield pa.RecordBatch.from_pydict({"label": pa.array(list(sums), pa.string()),
                                              "v": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})

    src = docs.where(docs[label_col].isNotNull()).select(docs[label_col].alias("label"), docs[text_col].cast("string").alias("text"))
    parts = src.mapInArrow(run, "label string, v array<double>")
    sums = (parts.select("label", F.posexplode("v").alias("place", "x")).groupBy("label", "place").agg(F.sum("x").alias("x"))
            .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v")))
    rows = sums.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels; this is no language column")
    rows = sorted((r["label"], np.array([p["x"] for p in r["v"]])) for r in rows)
    rows = [(n, v / np.linalg.norm(v)) for n, v in rows if v.any()]
    return Prototypes(tuple(n for n, _ in rows), np.array([v for _, v in rows]).reshape(len(rows), dims))


def predict(docs: DataFrame, model: Prototypes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``) for every row. No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names, vectors, dims = model.names, model.vectors.astype(np.float32), model.vectors.shape[1]

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for b in blocks(batches, "text", **_BLOCK):
            n = b.num_rows
            pred, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
            if names:
                p = Profiles(texts_of(b), dims, known)
                h = p.bundle(np.arange(n), n, np.float32)
                norm = np.sqrt((h.astype(np.float64) ** 2).sum(axis=1))
                cos = (h @ vectors.T) / np.maximum(norm, 1e-9)[:, None]
                best = cos.argmax(axis=1)
                pred = np.where(p.has_letter, np.array(names, dtype=object)[best], UNKNOWN)
                score = np.where(p.has_letter, np.clip(cos.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "lang_pred": pa.array(pred.tolist(), pa.string()),
                                              "score": pa.array(score.astype(np.float64))})

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
