import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from parley.llm import ctw, queries
from parley.llm.common import fold


def brute_tree(train, depth):
    """Recursive context-tree weighting over counts; returns log10 of a byte after its context."""
    counts = {}
    for t in train:
        b = [255] * depth + list(t) + [255]
        for i in range(depth, len(b)):
            for bit in range(8):
                prefix, one = 1 << bit | b[i] >> (8 - bit), b[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts.setdefault((tuple(b[i - d:i]), prefix), [0, 0])[one] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def weigh(ctx, prefix):
        if (ctx, prefix) not in memo:
            a, b = counts[(ctx, prefix)]
            own = kt(a, b)
            if len(ctx) == depth:
                memo[(ctx, prefix)] = own, None
            else:
                below = sum(weigh((x, *ctx), prefix)[0] for x in range(256) if ((x, *ctx), prefix) in counts)
                top = max(own, below)
                memo[(ctx, prefix)] = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2), below
        return memo[(ctx, prefix)]

    def chance(ctx, prefix, d):
        """Of a 1, from context length d on."""
        c = tuple(ctx[len(ctx) - d:])
        if (c, prefix) not in counts:
            return 0.5
        a, b = counts[(c, prefix)]
        own = (b + 0.5) / (a + b + 1)
        if d == depth:
            return own
        w = 1 / (1 + math.exp(min(700, weigh(c, prefix)[1] - kt(a, b))))
        return w * own + (1 - w) * chance(ctx, prefix, d + 1)

    def score(text):
        b, total = [255] * depth + list(text) + [255], 0.0
        for i in range(depth, len(b)):
            for bit in range(8):
                p = chance(b[i - depth:i], 1 << bit | b[i] >> (8 - bit), 0)
                total += math.log10(p if b[i] >> (7 - bit) & 1 else 1 - p)
        return total
    return score


TRAIN = ["the cat sat on the mat", "the dog sat", "a cat", "", "tHe CAT \u00e9", "the cat sat on the mat"]
TEST = TRAIN + ["zebra", "the mat", "\u6f22"]


def docs_of(spark):
    return spark.createDataFrame([(i, t, i < len(TRAIN)) for i, t in enumerate(TEST)], "doc_id long, text string, train boolean")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()


def test_score_against_the_recursion(spark):
    df = docs_of(spark)
    rows = {r["doc_id"]: r for r in ctw.score(df, df["train"], depth=3).collect()}
    want = brute_tree([lower(t) for t in TRAIN], 3)
    for i, t in enumerate(TEST):
        assert abs(rows[i]["score"] - want(lower(t))) < 1e-4 * max(1, abs(want(lower(t)))), t
        assert abs(rows[i]["bits_per_byte"] + want(lower(t)) / math.log10(2) / (len(lower(t)) + 1)) < 1e-3


def test_probabilities_of_the_next_byte_add_up(spark):
    df = docs_of(spark)
    asked = [c[0] << 16 | c[1] << 8 | x for c in (b"th", b"zz", b"\xff\xff") for x in range(256)]
    counts = ctw.corpus_counts(df.where("train"), 2).union(spark.createDataFrame([("g", g, 0, 1) for g in asked], "kind string, key long, n long, every long"))
    counts = counts.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))
    value = {r["key"]: r["value"] for r in ctw.gram_values(counts, 2).collect()}
    for context in range(0, len(asked), 256):
        assert abs(sum(10 ** value[g] for g in asked[context:context + 256]) - 1) < 1e-9


def test_lookup_finds_exactly_its_keys():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(0, 1 << 40, n))
        table = ctw.Lookup(keys, keys * 0.5)
        asked = np.concatenate([keys, rng.integers(0, 1 << 40, 1000), np.arange(50)])
        hit, value = table.find(asked)
        assert np.array_equal(hit, np.isin(asked, keys)) and np.array_equal(value, np.where(hit, asked * 0.5, 0))


def brute_base(texts, training):
    token = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", lower(t)) + [None]
    c = Counter(w for t, use in zip(texts, training) if use for w in token(t))
    n, v = sum(c.values()), len(c)
    return [(len(token(t)), sum(c[w] > 0 for w in token(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in token(t))) for t in texts]


def test_word_base(spark, texts):
    ids, body = zip(*texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    use = [fold(i, 10) != 0 for i in ids]
    want = dict(zip(ids, brute_base(body, use)))
    for few in (1 << 20, 5):  # all words frequent; nearly all joined by hash
        out = ctw.score(df, queries._fold(10) != 0, depth=1, frequent=few).collect()
        for r in out:
            n, known, total, base = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
            assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))


def test_training_lowers_the_code_length(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = ctw.score(df, queries._fold(10) != 0).collect()
    held = [r["bits_per_byte"] for r in rows if fold(r["doc_id"], 10) == 0]
    assert np.mean(held) < 4


def test_odd_rows(odd, empty):
    rows = ctw.score(odd, odd["doc_id"] > 3).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1
    assert by[1]["score"] == by[2]["score"]
    assert all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in rows)
    untrained = ctw.score(odd, odd["doc_id"] > 1000).collect()
    assert {round(r["bits_per_byte"], 6) for r in untrained} == {8.0} and {r["train_tokens"] for r in untrained} == {0}
    assert ctw.score(empty, empty["doc_id"] > 0).count() == 0


def test_every_context_is_kept_whatever_the_number_sent_to_the_tasks(spark, texts):
    """No node is pooled, also where hardly any gram is sent to the tasks."""
    some = texts[:12]
    df = spark.createDataFrame([(i, t, k < 8) for k, (i, t) in enumerate(some)], "doc_id long, text string, train boolean")
    want = brute_tree([lower(t) for _, t in some[:8]], 4)
    for few in (3, 1 << 20):
        got = {r["doc_id"]: r["score"] for r in ctw.score(df, df["train"], frequent=few).collect()}
        for i, t in some:
            assert abs(got[i] - want(lower(t))) < 1e-9 * abs(want(lower(t))), (few, i)


def test_groups_cut_anywhere_give_the_same(spark, texts):
    """The table of grams in one batch or in batches of three rows."""
    import pyarrow as pa
    row = sorted((int(g) >> 8 & 0xFFFFFF, int(g)) for g in set(ctw.grams([lower(t) for _, t in texts[:5]])[1].tolist()))
    key = np.array([g for _, g in row])
    batch = pa.RecordBatch.from_pydict({"key": key, "n": key % 3, "every": key % 3 + 1})
    cut = list(ctw._groups([batch.slice(i, 3) for i in range(0, len(key), 3)], 0xFFFFFF))
    assert np.array_equal(np.concatenate([g for g, _, _ in cut]), key)
    groups = [set((g >> 8 & 0xFFFFFF).tolist()) for g, _, _ in cut]
    assert sum(map(len, groups)) == len(set().union(*groups))
