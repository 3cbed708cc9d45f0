"""Metrics against plain Python on small inputs."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.operators import metrics as met


def distance(a, b):
    """Table of distances of all prefixes."""
    table = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    return table[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcde"), max_size=14))
def test_word_edits_by_bit_vectors(a, b):
    assert met._edits(a, b) == distance(a, b)


def test_word_edits_of_long_texts():
    rng = random.Random(1)
    a = [rng.choice("abcdefgh") for _ in range(400)]
    b = [x for x in a if rng.random() < 0.9]
    b[50:50] = ["new"] * 7
    assert met._edits(a, b) == distance(a, b)


def test_two_million_distinct_words_have_a_distance(spark):
    n = 1_000_000
    one, other = " ".join(f"a{i}" for i in range(n)), " ".join(f"b{i}" for i in range(n))
    words = [f"a{i}" for i in range(n)]
    words[400_000:400_003] = ["x", "y"]
    rows = [(one, other), (one, " ".join(words)), (None, "a b"), ("a", None), ("", "")]
    out = met.word_edits(spark.createDataFrame(rows, "ref string, hyp string")).select("edits", "ref_words").collect()
    assert [tuple(r) for r in out] == [(n, n), (3, n), (2, 0), (1, 1), (0, 0)]


def test_text_of_label_ids(spark):
    vocab = ["[PAD]", "|", "a", "b"]
    df = spark.createDataFrame([([2, 2, 1, 3, -100, -100],), ([-100],), ([3, 0, 3],)], "ids array<int>")
    assert [r[0] for r in df.select(met.label_text(F.col("ids"), vocab)).collect()] == ["aa b", "", "bb"]


number = st.one_of(st.none(), st.floats(width=64), st.integers(-3, 3).map(float))


@settings(max_examples=20, deadline=None)
@given(st.lists(number, max_size=40))
def test_percentiles_equal_a_sort(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = met.percentiles(df, "v", [0.0, 0.5, 0.95, 1.0])
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    for p, x in zip([0.0, 0.5, 0.95, 1.0], got):
        if not kept:
            assert x is None
            continue
        at = (len(kept) - 1) * p
        a, b = kept[math.floor(at)], kept[math.ceil(at)]
        want = a if a == b else a + (b - a) * (at - math.floor(at))
        assert x == want or math.isnan(x) and math.isnan(want)


def test_ranks_of_a_column_with_extreme_spread(spark):
    values = [5e-324, 1e-300, -1e308, 1e308, 0.0, 1.0, 1.0 + 2 ** -52] + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert met.order_statistics(df, "v", range(len(values)), parts=4) == dict(enumerate(sorted(values)))


def test_entities_on_ids_leave_out_the_ignored_positions(spark):
    # gold: card at 1-2, person at 4; predicted: card at 1-2, nothing at 4, and an entity at an ignored place
    rows = [(1, [-100, 3, 4, 0, 7, -100], [5, 3, 4, 0, 0, 5])]
    r = met.entity_f1_ids(spark.createDataFrame(rows, "row int, g array<int>, p array<int>"), "g", "p").first()
    assert (r.tp, r.n_pred, r.n_gold, r.precision, r.recall, r.accuracy) == (1, 1, 2, 1.0, 0.5, 0.75)


@pytest.mark.parametrize("warmup", [0, 1, 3])
def test_means_after_warm_up(spark, warmup):
    rng = random.Random(2)
    rows = [(b, i, float(rng.randrange(100))) for b in ("x", "y", None) for i in range(5 if b == "x" else 2)]
    got = met.latency_means(spark.createDataFrame(rows, "b string, i int, v double").repartition(4), "b", ["i"], "v", warmup)
    want = {}
    for b, i, v in rows:
        if i >= warmup:
            want.setdefault(b, []).append(v)
    assert {r.b: (r.n_runs, r["mean"]) for r in got.collect()} == {b: (len(v), round(sum(v) / len(v), 6)) for b, v in want.items()}
