"""Operator 9: language-model scoring by context-tree weighting over bytes.

Model: every byte is eight binary decisions; each decision under each context of 0 to ``DEPTH`` preceding
bytes has a Krichevsky-Trofimov estimator. Context-tree weighting gives a context's data the
probability 1/2 of its own estimator + 1/2 of the product over its longer contexts, which mixes all
depths at once. A trained model predicts with the weights that the training data leave:

    p(s) = (w p_KT(s) + (1 - w) p(longer context)),  w = KT(s) / (KT(s) + product over longer contexts)

Every context of the training rows has its node; a context never seen predicts 1/2. The grams (a byte and its
``DEPTH`` bytes of context) of all rows are one table, dealt by the last ``TOP`` + 1 bytes of the context: all
nodes of longer contexts lie within one such group (at most 256 ** (``DEPTH`` - ``TOP``) grams), so their weights
and chances are computed group by group. Nodes of shorter contexts are at most 255 * 256 ** ``TOP``, a bound of the
byte alphabet and not of the input; these go to the tasks. The result is a table of every gram's log probability.
The values of about ``FREQUENT`` frequent grams go to the tasks that read the texts, all others are joined.

Texts are their bytes with A-Z lower-cased, between bytes 0xFF that no UTF-8 text has: they fill the first
contexts, and one marks the end, which is predicted too. So probabilities add up over all texts.

Word base: a smoothed unigram score over words ``[^\\x20\\x09-\\x0D]+`` and one end per text. Counts of the
``FREQUENT`` most frequent words go to the tasks; all others are joined by word hash (64 bits).

Defined results: null and empty texts are scored as an end alone; without training rows every byte costs
8 bits; repeated rows are scored each and train each; only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, materialize
from .common import blocks, lower_ascii, texts_of

DEPTH = 4
TOP = 2
FREQUENT = 400_000
EDGE = 0xFF
_LOG2 = np.log(2)

def words_of(text: bytes) -> list[bytes]:
    """Runs without ``[\\x20\\x09-\\x0D]``, the bytes that ``split`` takes for white space."""
    return text.split()


def word_hash(word: bytes) -> int:
    """Signed 64 bits; 0 is the end token."""
    h = xxhash.xxh64_intdigest(word, 42)
    return (h - (1 << 64) if h >= 1 << 63 else h) or 1


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(text number, gram) of every byte and end: the byte below ``depth`` bytes of context, as one number."""
    edge = bytes([EDGE])
    joined = np.frombuffer(b"".join(edge * depth + t + edge for t in texts), dtype=np.uint8).astype(np.uint64)
    size = np.array([len(t) + depth + 1 for t in texts], dtype=np.int64)
    key = np.zeros(len(joined) - depth, dtype=np.uint64)
    for i in range(depth + 1):
        key = key << np.uint64(8) | joined[i:len(joined) - depth + i]
    row = np.repeat(np.arange(len(texts)), size)[:len(key)]
    start = np.cumsum(size) - size
    inside = np.arange(len(key)) - start[row] <= size[row] - depth - 1  # whole gram within the text
    return row[inside], key[inside].astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8; relative error below 1e-12 for x > 0."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(first, append=len(keys))


class Lookup:
    """Values of keys (0 or more) by open addressing: a key is found in one or two steps, without a search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length() + 1)
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits)
        slot = self._first(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several one stays
            put = self.keys[slot] == keys
            self.values[slot[put]] = values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.last

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each key is there, its value or 0)."""
        slot = self._first(keys)
        at = self.keys[slot]
        hit = at == keys
        value = np.where(hit, self.values[slot], 0.0)
        left = np.flatnonzero(~hit & (at >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            at = self.keys[slot[left]]
            same = at == keys[left]
            hit[left[same]], value[left[same]] = True, self.values[slot[left[same]]]
            left = left[~same & (at >= 0)]
        return hit, value


def corpus_counts(docs: DataFrame, depth: int = DEPTH, training: Column | None = None) -> DataFrame:
    """(kind, key, n, every) of grams (``g``) and word hashes (``w``, ends under hash 0) of ``docs`` (text).

    ``n`` counts the rows where ``training`` holds (all without it), ``every`` counts all rows; grams come from all
    rows, words from training rows only.
    """

    def run(batches):
        for b in blocks(batches, "text"):
            texts = [lower_ascii(t).encode() for t in texts_of(b)]
            use = np.asarray(b.column("use"), dtype=bool)
            row, gram = grams(texts, depth)
            of_training = use[row]
            seen, n = tallied(gram[of_training])
            unseen, every = tallied(gram[~of_training])
            learnt = [t for t, u in zip(texts, use) if u]
            words = Counter()
            for t in learnt:
                words.update(words_of(t))
            key = np.array([0, *map(word_hash, words)] if learnt else [], dtype=np.int64)
            count = np.array([len(learnt), *words.values()] if learnt else [], dtype=np.int64)
            for kind, k, c, e in (("g", seen, n, n), ("g", unseen, np.zeros(len(unseen)), every), ("w", key, count, count)):
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(k), pa.string()), "key": pa.array(k),
                                                  "n": pa.array(c.astype(np.int64)), "every": pa.array(e.astype(np.int64))})

    use = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    src = docs.select(docs["text"].cast("string").alias("text"), use.alias("use"))
    return (src.mapInArrow(run, "kind string, key bigint, n bigint, every bigint")
            .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("every").alias("every")))


def shorter(node: np.ndarray, a: np.ndarray, b: np.ndarray, log_w: np.ndarray, d: int) -> tuple[np.ndarray, ...]:
    """(keys, zeros, ones, sum of ``log_w``) of the nodes of depth ``d`` above nodes of depth ``d`` + 1."""
    key, at = np.unique((node >> 8 & ((1 << 8 * d) - 1)) << 8 | node & 255, return_inverse=True)
    return key, *(np.bincount(at, weights=x, minlength=len(key)) for x in (a, b, log_w))


def mixed(a: np.ndarray, b: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chance of a 1 by the node's own estimator, its weight, log weighted probability); ``below`` is the log of the
    product over the longer contexts."""
    kt = log_kt(a, b)
    weight = 1 / (1 + np.exp(np.clip(below - kt, -700, 700)))
    return (b + 0.5) / (a + b + 1.0), weight, np.logaddexp(kt, below) - _LOG2


def bits_of(gram: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bits of the gram's byte before ``bit``, led by a 1; the bit itself)."""
    byte = gram & 255
    return (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1


def _find(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``key`` are among the sorted ``keys``, and where those are)."""
    if not len(keys):
        return np.zeros(len(key), dtype=bool), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    return hit, at[hit]


def longer_contexts(gram: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Of whole groups of grams (all that share ``top`` + 1 bytes of context) with their training counts.

    (bit x gram: chance of a 1 by the contexts longer than ``top``; the nodes of depth ``top`` as of ``shorter``).
    """
    seen, context = n > 0, gram >> 8
    chance, above = np.full((8, len(gram)), 0.5), []
    for bit in range(8):
        prefix, one = bits_of(gram, bit)
        node, at = np.unique((context << 8 | prefix)[seen], return_inverse=True)
        b = np.bincount(at, weights=(n * one)[seen], minlength=len(node))
        a = np.bincount(at, weights=(n * (1 - one))[seen], minlength=len(node))
        log_w = log_kt(a, b)
        hit, i = _find(node, context << 8 | prefix)
        chance[bit, hit] = ((b + 0.5) / (a + b + 1.0))[i]
        for d in range(depth - 1, top, -1):
            node, a, b, below = shorter(node, a, b, log_w, d)
            own, weight, log_w = mixed(a, b, below)
            hit, i = _find(node, (context & ((1 << 8 * d) - 1)) << 8 | prefix)
            chance[bit, hit] = weight[i] * own[i] + (1 - weight[i]) * chance[bit, hit]
        above.append(shorter(node, a, b, log_w, top))
    return chance, tuple(np.concatenate(x) for x in zip(*above))


def short_contexts(node: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray, top: int) -> list[tuple[np.ndarray, ...]]:
    """By depth from 0 to ``top``, (sorted keys, own chance, weight) from the nodes of depth ``top``."""
    by = np.argsort(node)
    node, a, b, below = node[by], a[by], b[by], below[by]
    levels = []
    for d in range(top, -1, -1):
        own, weight, log_w = mixed(a, b, below)
        levels.append((node, own, weight))
        if d:
            node, a, b, below = shorter(node, a, b, log_w, d - 1)
    return levels[::-1]


def log10_of(gram: np.ndarray, chance: np.ndarray, levels: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """log10 probability of the last byte of each gram: ``chance`` by the longer contexts under all shorter ones."""
    total = np.zeros(len(gram))
    for bit in range(8):
        prefix, one = bits_of(gram, bit)
        p, left = np.zeros(len(gram)), np.ones(len(gram))
        for d, (keys, own, weight) in enumerate(levels):
            hit, i = _find(keys, (gram >> 8 & ((1 << 8 * d) - 1)) << 8 | prefix)
            p[hit] += left[hit] * weight[i] * own[i]
            left[hit] *= 1 - weight[i]
        p += left * chance[bit]
        total += np.log10(np.where(one == 1, p, 1 - p))
    return total


def _groups(batches: Iterable[pa.RecordBatch], mask: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(gram, n, every) of sorted batches, cut where the group changes."""
    held = (np.zeros(0, dtype=np.int64),) * 3
    for batch in batches:
        rows = tuple(np.concatenate([h, np.asarray(batch.column(c))]) for h, c in zip(held, ("key", "n", "every")))
        group = rows[0] >> 8 & mask
        cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
        held = tuple(x[cut:] for x in rows)
        if cut:
            yield tuple(x[:cut] for x in rows)
    if len(held[0]):
        yield held


def gram_values(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, every, value): log10 probability of every gram of ``corpus_counts``, under all nodes of the training rows."""
    if depth < 1:
        raise ValueError("depth must be 1 or more")
    top = min(TOP, depth - 1)
    mask = (1 << 8 * (top + 1)) - 1
    group = F.shiftright("key", 8).bitwiseAND(F.lit(mask))
    dealt = cut_lineage(counts.where("kind = 'g'").select("key", "n", "every", group.alias("group")).repartition("group")
                        .sortWithinPartitions("group", "key").drop("group"))

    def nodes(batches):
        for gram, n, _ in _groups(batches, mask):
            node, a, b, below = longer_contexts(gram, n, depth, top)[1]
            yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "a": pa.array(a, pa.float64()),
                                              "b": pa.array(b, pa.float64()), "below": pa.array(below, pa.float64())})

    # at most 255 * 256 ** top nodes
    table = (dealt.mapInArrow(nodes, "node bigint, a double, b double, below double").groupBy("node")
             .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below")).toArrow())
    own = counts.sparkSession.sparkContext.broadcast(short_contexts(*(np.asarray(table.column(c)) for c in ("node", "a", "b", "below")), top))

    def values(batches):
        for gram, n, every in _groups(batches, mask):
            value = log10_of(gram, longer_contexts(gram, n, depth, top)[0], own.value)
            yield pa.RecordBatch.from_pydict({"key": pa.array(gram), "every": pa.array(every), "value": pa.array(value)})

    return dealt.mapInArrow(values, "key bigint, every bigint, value double")


def frequent_grams(values: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, values) of the grams from a count on that leaves at most ``most``, found by a count per eighth of a
    power of two (504 rows at most)."""
    step = F.floor(F.log2("every") * 8)
    least, left = 1 << 10, 0
    for k, n in sorted(((r["k"], r["count"]) for r in values.groupBy(step.alias("k")).count().collect()), reverse=True):
        left += n
        if left > most:
            break
        least = k
    table = values.where(step >= least).select("key", "value").toArrow()
    order = np.argsort(np.asarray(table.column("key")))
    return np.asarray(table.column("key"))[order], np.asarray(table.column("value"))[order]


def _lists(row: np.ndarray, at: np.ndarray, key: np.ndarray, n: int) -> pa.ListArray:
    """By row from 0 to ``n`` - 1, the distinct ``key[at]`` with how often they occur."""
    pair, tf = np.unique(row * max(len(key), 1) + at, return_counts=True)
    ends = np.searchsorted(pair, np.arange(n + 1) * max(len(key), 1))
    found = pa.StructArray.from_arrays([pa.array(key[pair % max(len(key), 1)]), pa.array(tf.astype(np.int64))], ["key", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found)


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          frequent: int = FREQUENT) -> DataFrame:
    """Every row of ``docs`` under a model of the rows where ``training`` holds.

    (id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10 probability of the text),
    ``bits_per_byte``: code length per byte, ends counted as bytes).
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    counts = cut_lineage(corpus_counts(docs.select(docs[text_col].alias("text"), training.alias("use")), depth, F.col("use")))
    values = materialize(gram_values(counts, depth), "ctw-grams")
    often = spark.sparkContext.broadcast(frequent_grams(values, frequent))  # at most ``frequent`` pairs of numbers
    words = counts.where("kind = 'w'").select(F.col("key").alias("word"), F.col("n").alias("c"))
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, floor = int(total["n"]), float(total["n"]) + 0.1 * (total["v"] + 1)
    top = words.orderBy(F.desc("c"), "word").limit(frequent).toArrow()  # at most ``frequent`` pairs of numbers
    order = np.argsort(np.asarray(top.column("word")))
    common = spark.sparkContext.broadcast((np.asarray(top.column("word"))[order], np.asarray(top.column("c"))[order]))

    def run(batches):
        table, (word, c) = Lookup(*often.value), common.value
        value = np.log10((c + 0.1) / floor)
        for b in blocks(batches, "text"):
            texts = [lower_ascii(t).encode() for t in texts_of(b)]
            n = len(texts)
            row, gram = grams(texts, depth)
            hit, worth = table.find(gram)
            log10 = np.bincount(row, weights=worth, minlength=n)
            rare, which = np.unique(gram[~hit], return_inverse=True)
            rare_grams = _lists(row[~hit], which, rare, n)

            split = [words_of(t) for t in texts]
            distinct = list(set().union(*split))
            number = dict(zip(distinct, range(1, len(distinct) + 1)))
            hashes = np.array([0, *map(word_hash, distinct)], dtype=np.int64)
            size = np.array([len(x) + 1 for x in split])
            flat = np.fromiter((i for x in split for i in (*map(number.__getitem__, x), 0)), dtype=np.int64, count=int(size.sum()))
            of = np.repeat(np.arange(n), size)
            at = np.minimum(np.searchsorted(word, hashes), max(len(word) - 1, 0))
            have = word[at] == hashes if len(word) else np.zeros(len(hashes), dtype=bool)
            worth = np.where(have, value[at] if len(word) else 0.0, 0.0)
            base = np.bincount(of, weights=worth[flat], minlength=n)
            known = np.bincount(of, weights=have[flat], minlength=n).astype(np.int64)
            other = ~have[flat]
            rest = _lists(of[other], flat[other], hashes, n)
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "n_tokens": pa.array(size.astype(np.int64)), "known": pa.array(known), "base": pa.array(base),
                "score": pa.array(log10), "n_bytes": pa.array(np.array([len(t) + 1 for t in texts], dtype=np.int64)),
                "rest": rest, "grams": rare_grams})

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    rows = src.mapInArrow(run, f"id {id_type}, n_tokens bigint, known bigint, base double, score double, n_bytes bigint, "
                               "rest array<struct<key:bigint,tf:bigint>>, grams array<struct<key:bigint,tf:bigint>>")
    # written once: the row numbers then stay what they are
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "ctw-rows")
    found = lambda c, gram: rows.select("row", F.explode(c).alias("r")).select("row", F.lit(gram).alias("gram"), "r.key", "r.tf")
    known = (words.select(F.lit(False).alias("gram"), F.col("word").alias("key"), F.log10((F.col("c") + 0.1) / F.lit(floor)).alias("value"))
             .union(values.select(F.lit(True), "key", "value")))
    of_gram, worth = F.col("gram"), F.coalesce("value", F.log10(F.lit(0.1) / F.lit(floor))) * F.col("tf")
    tail = (found("rest", False).union(found("grams", True)).join(known, ["gram", "key"], "left").groupBy("row")
            .agg(F.sum(F.when(~of_gram, worth)).alias("more"),
                 F.sum(F.when(~of_gram & F.col("value").isNotNull(), F.col("tf"))).alias("more_known"),
                 F.sum(F.when(of_gram, F.col("value") * F.col("tf"))).alias("more_score")))
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    out = rows.drop("rest", "grams").join(tail, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                      score.alias("score"), (-score / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
