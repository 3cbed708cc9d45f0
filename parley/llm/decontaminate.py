"""Operator 4: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

* Seeds: the word n-grams (``N`` = 3) of the test items. A first pass over the training documents counts in
  how many each occurs; a seed is rare if that is at most ``RARE_SHARE`` of the documents, and the rarest
  half of an item's seeds are used in any case, so no item goes without.
* Join: a second pass looks up the documents' n-grams among the rare seeds by binary search. Seeds that
  agree on where the item begins open one window of the document around it.
* Alignment: each window is aligned locally with its item, word by word (match 1, mismatch and gap
  -1/2), items of any length as a whole by rolling anti-diagonals. The score is the best alignment of one window
  over the item's number of words; pairs from ``MIN_SCORE`` on are leaks. Edited copies keep enough intact n-grams to be found, and the alignment judges the rest.

The items are a stated query set: they go to the tasks in blocks of about ``BLOCK_SEEDS`` seeds (a longer item is a
block of its own), with two passes over the documents a block. Documents are never shuffled, so a passage in a third of all
documents is spread like the documents are.

Words are maximal runs of ASCII digits, letters and non-ASCII characters, A-Z lower-cased. Defined results:
null and empty texts on either side have no seeds and match nothing, as have items of fewer words
than ``N``; documents are read whole; repeated rows of either table give repeated pairs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, lower_ascii, texts_of

N = 3
RARE_SHARE = 0.002
MIN_SCORE = 0.5
BLOCK_SEEDS = 1_000_000

_words = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+").findall


def words_of(text: str) -> list[str]:
    return _words(lower_ascii(text))


@dataclass(frozen=True)
class Items:
    """A block of test items with the seeds to search for."""

    ids: list  # by item
    codes: list[np.ndarray]  # by item: word numbers
    vocabulary: dict[str, int]
    grams: np.ndarray  # distinct seeds, sorted
    first: np.ndarray  # by seed, where its places begin
    item: np.ndarray  # by place
    at: np.ndarray  # by place: word of the item
    pairs: np.ndarray  # distinct beginnings of seeds, sorted: numbers of word pairs
    rare: np.ndarray | None = None  # by seed; all are without it

    def gram_codes(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the trigrams of a row of word numbers; -1 where its words are unknown or no item begins a
        trigram with its first two. A pair's place among the known pairs keeps the numbers small for any vocabulary."""
        v = len(self.vocabulary)
        n = len(words) - N + 1
        if n <= 0 or not len(self.pairs):
            return np.full(max(n, 0), -1, dtype=np.int64)
        out = np.full(n, -1, dtype=np.int64)
        at = np.flatnonzero((words[:n] >= 0) & (words[1:n + 1] >= 0) & (words[2:] >= 0))
        pair = words[at] * v + words[at + 1]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[place] == pair
        out[at[known]] = place[known] * v + words[at[known] + 2]
        return out


def index_items(ids: list, texts: list[str]) -> Items:
    split = [words_of(t) for t in texts]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*split)))} if split else {}
    codes = [np.array([vocabulary[w] for w in s], dtype=np.int64) for s in split]
    none = np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.concatenate([none, *(c[:-2] * len(vocabulary) + c[1:-1] for c in codes if len(c) >= N)]))
    empty = Items(ids, codes, vocabulary, none, none, none, none, pairs)
    gram = [empty.gram_codes(c) for c in codes]
    flat = np.concatenate([*gram, none])
    item = np.repeat(np.arange(len(codes)), [len(g) for g in gram])
    at = np.concatenate([*(np.arange(len(g)) for g in gram), none]).astype(np.int64)
    return _places(empty, flat, item, at)


def _places(items: Items, flat: np.ndarray, item: np.ndarray, at: np.ndarray) -> Items:
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    return Items(items.ids, items.codes, items.vocabulary, grams, np.append(first, len(flat)), item[order], at[order], items.pairs)


def _some(items: Items, keep: np.ndarray) -> Items:
    return _places(items, np.repeat(items.grams, np.diff(items.first))[keep], items.item[keep], items.at[keep])


def keep_rare(items: Items, df: np.ndarray, most: float) -> Items:
    """The places of seeds with a document count from 1 to ``most``, and the rarest half of each item's that occur."""
    count = np.repeat(df, np.diff(items.first))
    present = count > 0
    order = np.lexsort((items.at, count, ~present, items.item))
    rank = np.empty(len(order), dtype=np.int64)
    sizes = np.bincount(items.item, minlength=len(items.ids))
    rank[order] = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = np.bincount(items.item[present], minlength=len(items.ids))
    return _some(items, present & ((count <= most) | (2 * rank < found[items.item])))


def mark_rare(items: Items, df: np.ndarray, most: float) -> Items:
    """All seeds that occur in a document, with the rare ones marked."""
    found = _some(items, np.repeat(df, np.diff(items.first)) > 0)
    return replace(found, rare=np.isin(found.grams, keep_rare(items, df, most).grams))


def seeds_in(items: Items, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, place in the document, seed) of a document's n-grams that are seeds."""
    get = items.vocabulary.get
    codes = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
    gram = items.gram_codes(codes)
    place = np.flatnonzero(gram >= 0)
    if not len(place) or not len(items.grams):
        none = np.zeros(0, dtype=np.int64)
        return codes, none, none
    i = np.minimum(np.searchsorted(items.grams, gram[place]), len(items.grams) - 1)
    hit = items.grams[i] == gram[place]
    return codes, place[hit], i[hit]


def slack(n_words: int) -> int:
    return n_words // 2 + 3


def windows(items: Items, place: np.ndarray, seed: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(item, first word, last word + 1, whether a rare seed is in it) of a document."""
    reps = np.diff(items.first)[seed]
    total = int(reps.sum())
    if not total:
        return []
    j = np.repeat(items.first[seed], reps) + np.arange(total) - np.repeat(np.cumsum(reps) - reps, reps)
    item, line = items.item[j], np.repeat(place, reps) - items.at[j]
    rare = np.ones(total, dtype=bool) if items.rare is None else np.repeat(items.rare[seed], reps)
    out, last = [], None
    for i, x, r in sorted(set(zip(item.tolist(), line.tolist(), rare.tolist()))):
        n = len(items.codes[i])
        if last and last[0] == i and x - last[1] <= slack(n):
            last[2:] = x, last[3] or r
        else:
            last = [i, x, x, r]
            out.append(last)
    return [(i, max(0, lo - slack(len(items.codes[i]))), hi + len(items.codes[i]) + slack(len(items.codes[i])), r) for i, lo, hi, r in out]


def most_matches(code: np.ndarray, words: np.ndarray) -> int:
    """Words that two rows have in common, repeated ones counted: no alignment has more matches."""
    word, n = np.unique(code, return_counts=True)
    at = np.minimum(np.searchsorted(word, words), len(word) - 1)
    have = np.bincount(at[word[at] == words], minlength=len(word))
    return int(np.minimum(n, have).sum())


def can_reach(code: np.ndarray, words: np.ndarray, min_score: float) -> bool:
    """Whether a window may align at the score."""
    return most_matches(code, words) >= min_score * len(code)


def align(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair of word rows, all pairs at once by anti-diagonals.

    (score with match 2, mismatch and gap -1; first and last + 1 word on the right).
    """
    n, li, lj = len(left), max(map(len, left)), max(map(len, right))
    a, b = np.full((n, li), -2, dtype=np.int64), np.full((n, lj), -3, dtype=np.int64)
    for k in range(n):
        a[k, :len(left[k])], b[k, :len(right[k])] = left[k], right[k]
    shape = (n, li + 1)
    one, two = np.zeros(shape, dtype=np.int32), np.zeros(shape, dtype=np.int32)
    one_at, two_at = np.zeros(shape, dtype=np.int32), np.zeros(shape, dtype=np.int32)
    best, begin, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    rows = np.arange(n)
    for d in range(li + lj - 1):
        lo, hi = max(0, d - lj + 1), min(li - 1, d)  # words of the left row on this diagonal
        j = d - np.arange(lo, hi + 1)
        same = a[:, lo:hi + 1] == b[:, j]
        step = two[:, lo:hi + 1] + np.where(same, 2, -1)
        at = np.where(two[:, lo:hi + 1] > 0, two_at[:, lo:hi + 1], j[None, :])
        up, side = one[:, lo:hi + 1] - 1, one[:, lo + 1:hi + 2] - 1
        at = np.where(up > step, one_at[:, lo:hi + 1], at)
        step = np.maximum(step, up)
        at = np.where(side > step, one_at[:, lo + 1:hi + 2], at)
        step = np.maximum(np.maximum(step, side), 0)
        now, now_at = np.zeros(shape, dtype=np.int32), np.zeros(shape, dtype=np.int32)
        now[:, lo + 1:hi + 2], now_at[:, lo + 1:hi + 2] = step, at
        top = step.argmax(axis=1)
        value = step[rows, top]
        better = value > best
        best = np.where(better, value, best)
        begin, end = np.where(better, at[rows, top], begin), np.where(better, j[top] + 1, end)
        two, two_at, one, one_at = one, one_at, now, now_at
    return best, begin, end


def _aligned(items: Items, tasks: list[tuple[int, int, int, np.ndarray]]):
    """(document, item, score, first word, last word + 1) of each window (document, item, offset, words)."""
    tasks = sorted(tasks, key=lambda t: (len(items.codes[t[1]]), len(t[3])))
    c = 0
    while c < len(tasks):
        # as many windows at once as keep the rows of numbers small; a very long item is alone
        step = max(1, min(256, 500_000 // max(1, len(items.codes[tasks[c][1]]), len(tasks[c][3]) // 4)))
        some = tasks[c:c + step]
        c += step
        found = align([items.codes[t[1]] for t in some], [t[3] for t in some])
        for (doc, i, lo, _), s, x, y in zip(some, *(v.tolist() for v in found)):
            yield doc, i, s / (2 * len(items.codes[i])), lo + x, lo + y


def leaks_in(items: Items, texts: list[str], min_score: float) -> list[tuple[int, int, float, int, int, int]]:
    """(document, item, best score, its first word and last + 1, number of places) at or above the score."""
    best: dict[tuple[int, int], list] = {}
    pending: list = []

    def settle():
        for d, i, s, x, y in _aligned(items, pending):
            if s >= min_score:
                old = best.get((d, i))
                top = old[:3] if old and (-old[0], old[1]) <= (-s, x) else [s, x, y]
                best[(d, i)] = [*top, [*(old[3] if old else []), (x, y)]]
        pending.clear()

    for doc, text in enumerate(texts):
        codes, place, seed = seeds_in(items, words_of(text))
        for i, lo, hi, rare in windows(items, place, seed):
            if not rare and not can_reach(items.codes[i], codes[lo:hi], min_score):
                continue
            pending.append((doc, i, lo, codes[lo:hi]))
            if len(pending) == 10_000:
                settle()
    settle()
    return [(d, i, s, x, y, _apart(spans)) for (d, i), (s, x, y, spans) in sorted(best.items())]


def _apart(spans: list[tuple[int, int]]) -> int:
    """Number of places, overlapping ones counted as one: two windows may hold the same copy."""
    n, end = 0, -1
    for x, y in sorted(spans):
        n += x >= end
        end = max(end, y)
    return n


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The items in blocks of at most about ``BLOCK_SEEDS`` words (by hash of the id)."""
    rows = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.char_length("text") / 2 + 1)).first()[0] or 0
    n = max(1, int(-(-size // BLOCK_SEEDS)))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [rows.where(part == k) for k in range(n)]


def _prepare(docs: DataFrame, block: DataFrame, text_col: str, n_docs: int, rare_share: float) -> Items:
    """A block's items (collected: bounded by the block) with the seeds that occur, rare ones marked, counted over all documents."""
    table = block.orderBy("id", "text").toArrow()
    items = index_items(table.column("id").to_pylist(), table.column("text").to_pylist())

    def count(batches):
        df = np.zeros(len(items.grams), dtype=np.int64)
        for b in blocks(batches, "text"):
            for text in texts_of(b):
                df[np.unique(seeds_in(items, words_of(text))[2])] += 1
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"seed": pa.array(hit), "n": pa.array(df[hit])})

    counted = (docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(count, "seed bigint, n bigint")
               .groupBy("seed").agg(F.sum("n").alias("n")).toArrow())
    df = np.zeros(len(items.grams), dtype=np.int64)
    df[np.asarray(counted.column("seed"))] = np.asarray(counted.column("n"))
    return mark_rare(items, df, rare_share * n_docs)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", min_score: float = MIN_SCORE, rare_share: float = RARE_SHARE) -> DataFrame:
    """(document id, item id, ``score``, ``first_word``, ``last_word``, ``n_places``): one row for each leaking pair."""
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    n_docs = docs.count()
    out = None
    for block in _item_blocks(items, item_id, item_text):
        own = docs.sparkSession.sparkContext.broadcast(_prepare(docs, block, text_col, n_docs, rare_share))

        def run(batches, own=own):
            for b in blocks(batches, "text"):
                found = leaks_in(own.value, texts_of(b), min_score)
                d, i, s, x, y, n = map(list, zip(*found)) if found else ([],) * 6
                yield pa.RecordBatch.from_pydict({
                    "id": b.column("id").take(pa.array(d, pa.int64())),
                    "item": pa.array([own.value.ids[k] for k in i], type=None if i else pa.int64()),
                    "score": pa.array(s, pa.float64()), "first_word": pa.array(x, pa.int64()),
                    "last_word": pa.array([k - 1 for k in y], pa.int64()), "n_places": pa.array(n, pa.int64())})

        src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
        part = src.mapInArrow(run, f"id {id_type}, item {item_type}, score double, first_word bigint, last_word bigint, n_places bigint")
        out = part if out is None else out.union(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_id})


def remove_leaking(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                   min_score: float = MIN_SCORE, rare_share: float = RARE_SHARE) -> DataFrame:
    """``docs`` without the documents that hold a test item. One filter pass a block of items, no shuffle."""
    n_docs = docs.count()
    out = docs
    for block in _item_blocks(items, item_id, item_text):
        own = docs.sparkSession.sparkContext.broadcast(_prepare(docs, block, text_col, n_docs, rare_share))

        def run(batches, own=own):
            for b in blocks(batches, text_col):
                keep = np.ones(b.num_rows, dtype=bool)
                keep[[x[0] for x in leaks_in(own.value, texts_of(b, text_col), min_score)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
