import random
import re

import numpy as np
import xxhash

from parley.llm import simhash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)][:len(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    ids = sorted(fps)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_query_against_brute_force(spark, texts):
    out = simhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    fps = {d: brute_fingerprint(t) for d, t in texts}
    want = brute_components(fps)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in out} == {(d, f"{f:016x}", want[d]) for d, f in fps.items()}


def test_links_find_every_distance(spark):
    """Chains and balls of planted fingerprints: same components as all pairs."""
    rng = random.Random(4)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(6):
            x = base
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 5])):
                x ^= 1 << b
            fps.add(x)
            base = x if rng.random() < 0.5 else base
    for bits in ([0, 1, 2], [0, 1, 40], [0, 33, 63], [31, 32, 33], [61, 62, 63]):
        base = rng.getrandbits(64)
        fps |= {base, base ^ sum(1 << b for b in bits)}
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(df).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in found)
    comp = simhash.components(df.withColumnRenamed("fp", "node"), simhash.links(df)).collect()
    want = {}
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    label = {x: x for x in signed}
    for _ in range(20):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    want = label
    assert {r["node"]: r["label"] for r in comp} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(300, 200), (300, 201)]
    nodes = sorted({x for e in edges for x in e} | {999})
    out = simhash.components(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["label"] for r in out.collect()}
    assert all(got[n] == 0 for n in range(61)) and all(got[n] == 100 for n in range(100, 180))
    assert got[300] == got[201] == 200 and got[999] == 999


def test_large_group_of_near_copies_stays_linear(spark):
    """Variants of one fingerprint: the links are a few stars, not all pairs."""
    base = 0x0123456789ABCDEF
    fps = [base] + [base ^ (1 << i) for i in range(64)] + [base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(i + 1, 64, 5)]
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    found = simhash.links(df)
    assert found.count() < 70 * len(fps)
    assert simhash.components(df.withColumnRenamed("fp", "node"), found).select("label").distinct().count() == 1


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[3]["fingerprint"] == "0" * 16
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[6]["component_id"] == 5
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] or -1) for r in kept.collect())
    assert ids == [-1, 1, 4, 5, 7, 8]
    assert simhash.one_of_each(empty).count() == 0


def test_one_row_of_each_component_where_ids_repeat(spark):
    a, b, c = "alpha beta gamma delta epsilon zeta eta", "one two three four five six seven eight", "red green blue black white grey pink"
    rows = [(1, a, "x"), (1, b, "x"), (2, b, "y"), (3, c, "z"), (1, a, "x"), (None, c, "n"), (None, "quite alone here now", "n"), (4, c, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in simhash.one_of_each(docs).collect()), key=repr)
    assert got == sorted([(1, a, "x"), (1, b, "x"), (3, c, "z"), (None, "quite alone here now", "n")], key=repr)
