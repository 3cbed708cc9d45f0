"""Operator 10: SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the
text's word shingles. Two fingerprints link when they differ in at most ``radius`` = 3 bits.

Links are found without comparing pairs. Two fingerprints at distance d <= 3 have a common variant
within 1 bit of one and 2 bits of the other, so each emits the variants of a ball of half the radius:

* distances 0 and 2 keep the parity of the bit count: 1 + 1 flips meet in the middle;
* distances 1 and 3 change it: the even side flips at most 1 bit, the odd side at most 2. Of three
  differing bits two lie in the same 32-bit half, so the odd side needs pairs of one half only.

Fingerprints meet by a shuffle on the variant. Within one variant the members of least flips (0 or
1) link to all others, as flips add up to 3 at most; a star around one of them therefore holds
every link's component, and the number of rows stays that of the emitted variants: no pairs of a
group are formed. Every link is verified by the bit distance after deduplication.

Before that, each fingerprint emits the variants of its two 32-bit halves (one half of a linked
pair differs in at most 1 bit); a fingerprint that meets no other there has no link and skips the
larger ball. Copies share a fingerprint and are represented once.

Components: smallest label over links, alternating star contraction with checkpoints.

Defined results: null and empty texts have fingerprint zero and link like any other; fewer words
than a shingle hash the whole sequence; repeated ids are repeated rows with one component; only the
id and text columns are read. A null id is no label: its row gets the smallest id linked, or null.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, blocks, free_name, lower_ascii, texts_of
from ..session import cut_lineage, shuffle_partitions

RADIUS = 3
SHINGLE = 3
SEED = 42

_words = re.compile(rb"[^\x20\x09-\x0D]+").findall


def fingerprints_of(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of a block of texts."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        words = _words(lower_ascii(text).encode())
        n = len(words)
        if not n:
            continue
        joined = b" ".join(words)
        if n <= shingle:
            hashes.append(digest(joined, SEED))
            counts[row] = 1
            continue
        ends = np.cumsum([len(w) + 1 for w in words])
        lo = [0, *ends[: n - shingle].tolist()]
        hi = (ends[shingle - 1:] - 1).tolist()
        hashes += [digest(joined[a:b], SEED) for a, b in zip(lo, hi)]
        counts[row] = n - shingle + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    flat = np.array(hashes, dtype=np.uint64)
    ends = np.cumsum(counts[full])
    bits = np.empty((len(full), 64), dtype=np.uint8)
    for k, (a, b) in enumerate(zip((ends - counts[full]).tolist(), ends.tolist())):
        ones = np.zeros(64, dtype=np.int64)
        for c in range(a, b, 200_000):  # a long text in pieces
            piece = flat[c:min(b, c + 200_000)]
            ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits[k] = 2 * ones > b - a
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, ``fp``): the fingerprint as a signed 64-bit integer. No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in blocks(batches, "text"):
            fp = fingerprints_of(texts_of(b), shingle)
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "fp": pa.array(fp.view(np.int64))})

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, f"id {id_type}, fp bigint").withColumnRenamed("id", id_col)


def _flip(bits) -> np.ndarray:
    return np.bitwise_or.reduce(np.uint64(1) << np.array(bits, dtype=np.uint64), axis=-1)


_ONE = _flip([[i] for i in range(64)])
_TWO = _flip([[i, j] for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)])
#: XOR masks and their numbers of flips
EVEN_MASKS = np.concatenate([[np.uint64(0)], _ONE])
ODD_MASKS = np.concatenate([EVEN_MASKS, _TWO])
MASK_FLIPS = np.concatenate([[0], np.ones(64), np.full(len(_TWO), 2)]).astype(np.int8)


def _ball(batches):
    """(fp, variant, flips) for every fingerprint: ball of 1 bit for even ones, of 2 for odd ones."""
    for b in batches:
        fps = np.asarray(b.column("fp")).view(np.uint64)
        odd = (np.bitwise_count(fps) & 1).astype(bool)
        for part, masks in ((fps[~odd], EVEN_MASKS), (fps[odd], ODD_MASKS)):
            for c in range(0, len(part), 512):
                p = part[c:c + 512]
                yield pa.RecordBatch.from_pydict({
                    "fp": pa.array(np.repeat(p, len(masks)).view(np.int64)),
                    "variant": pa.array((p[:, None] ^ masks[None, :]).ravel().view(np.int64)),
                    "flips": pa.array(np.tile(MASK_FLIPS[:len(masks)], len(p)))})


_HALF = np.concatenate([[np.uint64(0)], _ONE[:32]])


def _half_keys(batches):
    """(fp, key) for both 32-bit halves: the half itself, and for halves of odd parity its 1-bit variants.

    Halves at distance 1 differ in parity, so the odd one meets the even one's own value.
    """
    for b in batches:
        fps = np.asarray(b.column("fp")).view(np.uint64)
        for half in (0, 1):
            part = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            odd = (np.bitwise_count(part) & 1).astype(bool)
            tag = np.uint64(half) << np.uint64(32)
            for sel, masks in ((~odd, _HALF[:1]), (odd, _HALF)):
                for c in range(0, int(sel.sum()), 4096):
                    p, q = part[sel][c:c + 4096], fps[sel][c:c + 4096]
                    yield pa.RecordBatch.from_pydict({
                        "fp": pa.array(np.repeat(q, len(masks)).view(np.int64)),
                        "key": pa.array(((p[:, None] ^ masks[None, :]) | tag).ravel().view(np.int64))})


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp``, enough of them to connect every component.

    Every returned link has a bit distance within the radius.
    """
    keys = distinct.select("fp").mapInArrow(_half_keys, "fp bigint, key bigint")
    # smallest and largest fingerprint of a key: they differ where two fingerprints meet
    met = keys.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
    # the small sides are checkpointed: both join inputs are then plain shuffles, which AQE can split when skewed
    open_ = keys.join(cut_lineage(met), "key", "left_semi").select("fp").distinct()
    # a row becomes up to 1057: spread them first
    open_ = cut_lineage(open_.repartition(shuffle_partitions(distinct.sparkSession), "fp"))
    ball = open_.mapInArrow(_ball, "fp bigint, variant bigint, flips tinyint")
    centre = ball.groupBy("variant").agg(F.coalesce(F.min(F.when(F.col("flips") == 0, F.col("fp"))),
                                                    F.min(F.when(F.col("flips") == 1, F.col("fp")))).alias("a"),
                                         F.max("fp").alias("hi"), F.min("fp").alias("lo"))
    centre = cut_lineage(centre.where("a is not null and lo <> hi").select("variant", "a"))
    star = ball.select("variant", F.col("fp").alias("b")).join(centre, "variant").where("a <> b")
    pairs = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def _state(edges: DataFrame) -> tuple:
    """Count and XOR of the row hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, label): smallest node of each node's component. ``edges``: (a, b).

    Alternating large-star and small-star steps: the edge list never grows, hubs link to the smallest
    neighbour by a partial aggregate, and each round's edges are checkpointed.
    """
    e = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(e)
    for _ in range(rounds):
        # large star: larger neighbours of u link to the smallest of u and its neighbours
        both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        big = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours link to the smallest of them
        big = big.where("u <> v").distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(e)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    lab = e.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    return nodes.join(lab, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(id, ``fp``) of every row; (``fp``, ``component_id``, ``chosen``: whether it holds its component's smallest id, the
    smallest fingerprint of those that do)."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    classes = cut_lineage(fps.groupBy("fp").agg(F.min(id_col).alias("least")))
    comp = components(classes.select(F.col("fp").alias("node")), links(classes)).withColumnRenamed("node", "fp")
    labelled = cut_lineage(classes.join(comp, "fp"))
    # checkpointed: the join with a hot label has two plain shuffles then, which AQE can split
    named = cut_lineage(labelled.groupBy("label").agg(F.min(F.when(F.col("least").isNotNull(), F.struct("least", "fp"))).alias("first")))
    first = F.col("first")
    return fps, cut_lineage(labelled.join(named, "label").select(
        "fp", first["least"].alias("component_id"), F.coalesce(first["fp"] == F.col("fp"), F.lit(False)).alias("chosen")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, ``fingerprint`` as 16 hex digits, ``component_id``: smallest id reachable by links)."""
    fps, of_fp = _components(docs, id_col, text_col, shingle)
    return fps.join(of_fp, "fp", "left").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each component: a row of its smallest id and, where that id has several texts in it, of
    the smallest fingerprint. An id that stands in several components is told apart by the fingerprint. Rows without
    an id stay where no row with an id is linked to them (they cannot be told apart, so all of them stay)."""
    fps, of_fp = _components(docs.select(id_col, text_col), id_col, text_col, shingle)
    stay = fps.join(of_fp.where("chosen"), "fp").where(F.col(id_col) == F.col("component_id")).select(id_col, "fp").distinct()
    stay = cut_lineage(stay)
    again = cut_lineage(fps.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("rows")).where("rows > 1").select(id_col))
    ids = stay.select(id_col)
    name = free_name(docs.columns, "fp")

    def marked(rows: DataFrame) -> DataFrame:
        return annotate(rows, lambda: lambda texts: {name: pa.array(fingerprints_of(texts, shingle).view(np.int64))}, f"{name} bigint", text_col)

    if again.isEmpty():
        kept = docs.join(ids, id_col, "left_semi").select(*docs.columns)
    else:
        once = docs.join(again, id_col, "left_anti").join(ids, id_col, "left_semi").select(*docs.columns)
        several = marked(docs.join(again, id_col, "left_semi").select(*docs.columns))
        several = several.join(stay.withColumnRenamed("fp", name), [id_col, name], "left_semi").dropDuplicates([id_col, name])
        kept = once.union(several.select(*docs.columns))
    lone = of_fp.where("component_id is null").select(F.col("fp").alias(name))
    if not lone.isEmpty():
        kept = kept.union(marked(docs.where(F.col(id_col).isNull())).join(lone, name, "left_semi").select(*docs.columns))
    return kept
