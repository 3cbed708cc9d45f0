import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.llm import resample as rs


def features(text, lo=1, hi=1):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [" ".join(words[i:i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, buckets=10_000, lo=1, hi=1, seed=2024):
    """(id, n_features, weight, score) of each row."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in docs for f in features(t, lo, hi)[1])
    g = Counter(at(f) for t in target for f in features(t, lo, hi)[1])
    gain = lambda b: math.floor(1000 * math.log((g[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(g.values()) + buckets))))
    known = {b: gain(b) for b in s}
    out = []
    for i, t in docs:
        found = features(t, lo, hi)[1]
        w = sum(known[at(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


@pytest.mark.parametrize("how", [{}, {"buckets": 7, "lo": 1, "hi": 3, "seed": 5}])
def test_weights_and_ranks_equal_a_sort(spark, texts, how):
    target = ["alpha beta", None, "the report of the day", texts[3][1]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = rs.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=25, min_words=20, **how)
    want = plain(texts, target, **how)
    fit = {i for i, t in texts if features(t)[0] >= 20}
    best = sorted((r for r in want if r[0] in fit), key=lambda r: (-r[3], r[0]))[:25 * len(fit) // 100]
    rank = {r[0]: n for n, r in enumerate(best, 1)}
    assert sorted(tuple(r) for r in got.collect()) == sorted((*r, rank.get(r[0])) for r in want)


@pytest.mark.parametrize("k", [0, 1, 5, 17, 59, 60])
def test_cutoff_among_ties(spark, k):
    rows = [(s, i, n) for n, (s, i) in enumerate([(7, 3)] * 20 + [(7, None)] * 15 + [(-(10 ** 15), i) for i in range(10)] + [(9, i) for i in range(15)])]
    scored = spark.createDataFrame(rows, "score long, id long, row long").repartition(6)
    ranked = {r["row"]: r["rank"] for r in rs._ranked(scored, k).collect()}
    best = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))[:k]
    assert ranked == {r[2]: n for n, r in enumerate(best, 1)}


def test_draw_returns_whole_rows(spark, odd):
    long = odd.where("doc_id is not null").withColumn("text", F.concat_ws(" ", F.coalesce("text", F.lit("")), F.lit("w " * 20)))
    docs = long.selectExpr("*", "1 as rank", "2 as row", "3 as id")
    target = odd.select("text")
    out = rs.draw(docs, target, percent=50)
    assert out.columns == [c for c in docs.columns if c != "rank"] + ["rank"]
    want = rs.resample(docs, target, percent=50).where("rank is not null").select("doc_id", "rank")
    assert sorted(tuple(r) for r in out.select("doc_id", "rank").collect()) == sorted(tuple(r) for r in want.collect())


def test_odd_tables(spark, odd, empty):
    out = rs.resample(odd, odd, min_words=0, percent=100)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, odd.count() + 1))
    none = {r["doc_id"]: tuple(r)[1:3] for r in out.collect() if r["doc_id"] in (1, 2, 3)}
    assert none == {1: (0, 0), 2: (0, 0), 3: (0, 0)}
    assert rs.resample(odd, empty).count() == odd.count()
    assert rs.resample(empty, odd).count() == 0 and rs.draw(empty, odd).count() == 0
    assert rs.resample(odd, odd, percent=0).where("rank is not null").count() == 0
