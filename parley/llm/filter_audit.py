"""Operator 12: what each filter of a chain removes, in every order of the filters, by decision diagrams.

1. ``failures`` marks, in one map pass, the filters that a document fails (a bit each) and a digest of its text;
   the filter for repeated texts compares ids with the smallest id of the text (a count by digest, combined on the map
   side; only digests of two rows or more are joined back).
2. Rows are counted by part, failure mask and label: at most 2^filters rows a part, whatever the input.
3. ``audit`` builds one diagram a part: a level for each filter, an edge for passing and one for failing, and at each
   node the counts of the rows below it. Equal subdiagrams are one node. Orders are visited by swaps of
   neighbouring levels (each order differs from the one before by one swap); a swap rebuilds two levels
   only. In each order the path of passing edges from the root gives the steps: the node after i edges counts what
   is kept, the failing edge beside it what is removed.

Parts are independent and go through Spark in groups of at most 2^filters rows.

Defined results: a null text is empty and has no words; a null part is the empty string; a null id is never
a copy and no smaller id; repeated rows are counted one by one, rows of the same id and text are no copies of each
other; labels of a repeated label row count if any of its rows has them, rows without a label have none; an empty table has no parts
and gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import blocks, texts_of

#: the filters, in the order of their bits
FILTERS = "ABCDE"
_SIGNS = re.compile(r"[#$%&*|]").search
_NO_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_mask(text: str) -> int:
    """Bits of the filters that look at the text alone: A short, B repetitive, C upper case, D signs."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    upper = len(raw) - len(raw.translate(None, _NO_UPPER))
    return (n < 200) | (100 * len(set(words)) < 50 * n) << 1 | (100 * upper > 3 * len(text)) << 2 | (_SIGNS(text) is not None) << 3


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask): the filters that each row fails."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in blocks(batches):
            texts = texts_of(b)
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "part": b.column("part"), "mask": pa.array([text_mask(t) for t in texts], pa.int32()),
                "digest": pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())})

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = cut_lineage(src.mapInArrow(run, f"id {id_type}, part string, mask int, digest binary"))
    copies = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    # checkpointed: the join below has two plain shuffles then, which AQE can split where a text is hot
    marked = rows.join(cut_lineage(copies.select("digest", "least")), "digest", "left")
    copy = F.when(F.col("id") > F.col("least"), 16).otherwise(0)
    return marked.select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part and failure mask, and those labelled quality = 1 and toxic = 1."""
    of_id = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    of_id = cut_lineage(of_id.where("good or toxic"))
    return masks.join(of_id, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


class Diagram:
    """Decision diagram of failure masks with the counts of the rows below each node.

    A node is (passing child, failing child) of the level below; terminals hold a tuple of counts. ``levels[i]``
    maps a node's children to its number, so equal subdiagrams of a level are one node.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int):
        self.order = list(range(filters))
        self.zero = (0,) * max((len(c) for c in counts.values()), default=3)
        self.ends: list[tuple[int, ...]] = []
        end_of: dict[tuple[int, ...], int] = {}
        below = []
        for mask in range(1 << filters):  # the last filter is the lowest bit of the path
            path = sum(1 << f for i, f in enumerate(self.order) if mask >> (filters - 1 - i) & 1)
            c = counts.get(path, self.zero)
            if c not in end_of:
                end_of[c] = len(self.ends)
                self.ends.append(c)
            below.append(end_of[c])
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(filters)]
        for level in reversed(range(filters)):
            number: dict[tuple[int, int], int] = {}
            below = [number.setdefault(pair, len(number)) for pair in zip(below[::2], below[1::2])]
            self.levels[level] = list(number)
        self._count()

    def _count(self, upto: int | None = None) -> None:
        """Counts below each node, from the lowest changed level up."""
        top = len(self.levels)
        if upto is None:
            self.counts = [[] for _ in range(top)] + [list(self.ends)]
            upto = top - 1
        for level in range(upto, -1, -1):
            down = self.counts[level + 1]
            self.counts[level] = [tuple(map(sum, zip(down[p], down[f]))) for p, f in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one; the levels above and below keep their nodes."""
        upper, lower = self.levels[level], self.levels[level + 1]
        number: dict[tuple[int, int], int] = {}
        new_upper = []
        for p, f in upper:
            (pp, pf), (fp, ff) = lower[p], lower[f]
            new_upper.append((number.setdefault((pp, fp), len(number)), number.setdefault((pf, ff), len(number))))
        self.levels[level], self.levels[level + 1] = new_upper, list(number)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        # the nodes of this level stand for the same rows as before, so only the level below is counted anew
        down = self.counts[level + 2]
        self.counts[level + 1] = [tuple(map(sum, zip(down[p], down[f]))) for p, f in self.levels[level + 1]]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts kept after it, counts it removes) along the path of passing edges."""
        out, node = [], 0
        for level, f in enumerate(self.order):
            passing, failing = self.levels[level][node]
            out.append((f, self.counts[level + 1][passing], self.counts[level + 1][failing]))
            node = passing
        return out


def swap_walk(n: int) -> Iterator[int]:
    """Levels whose swaps visit all orders of ``n`` filters, each once: the largest filter moves through the others
    and back, with one step of the walk of the others between."""
    if n < 2:
        return
    inner, down = swap_walk(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def audit_part(counts: dict[int, tuple[int, int, int]], names: Sequence[str] = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    n = len(names)
    failing = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, (0, 0, 0))[0] for f in range(n)]
    diagram = Diagram(counts, n)
    rows, shapley = [], [0] * n
    walk = swap_walk(n)
    for _ in range(math.factorial(n)):
        order = "".join(names[f] for f in diagram.order)
        for step, (f, kept, gone) in enumerate(diagram.steps(), 1):
            shapley[f] += gone[0]
            rows.append((order, step, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], f))
        if (level := next(walk, None)) is not None:
            diagram.swap(level)
    return [(*r[:-1], shapley[r[-1]]) for r in rows]


COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COLUMNS[2:])


def audit(counted: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from (part, mask, n, good, toxic)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in rows[["mask", "n", "good", "toxic"]].itertuples(index=False)}
        out = pd.DataFrame(audit_part(counts, names), columns=COLUMNS)
        out.insert(0, "part", key[0])
        return out.astype({"step": np.int32})

    return counted.groupBy("part").applyInPandas(run, SCHEMA)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of the five filters over ``docs``."""
    return audit(mask_counts(failures(docs, id_col, text_col, part_col), labels, id_col))
