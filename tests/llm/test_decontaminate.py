import random
import re

import numpy as np

from parley.llm import decontaminate as dc


def brute_align(a, b):
    """Smith-Waterman cell by cell: match 2, mismatch and gap -1."""
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, prev[j - 1] + (2 if x == y else -1), prev[j] - 1, row[-1] - 1))
        best, prev = max(best, *row), row
    return best


def test_alignment_against_cells():
    rng = random.Random(5)
    left = [np.array([rng.randrange(5) for _ in range(rng.randrange(1, 12))]) for _ in range(60)]
    right = [np.array([rng.randrange(5) for _ in range(rng.randrange(1, 25))]) for _ in range(60)]
    score, first, last = dc.align(left, right)
    for a, b, s, x, y in zip(left, right, score, first, last):
        assert s == brute_align(a.tolist(), b.tolist())
        if s:
            assert brute_align(a.tolist(), b[x:y].tolist()) == s


def edited(words, share, rng, filler):
    out = []
    for w in words:
        u = rng.random()
        if u < share / 3:
            out.append(rng.choice(filler))
        elif u < 2 * share / 3:
            continue
        elif u < share:
            out += [w, rng.choice(filler)]
        else:
            out.append(w)
    return out


def items_and_docs(texts):
    rng = random.Random(1)
    filler = [w for _, t in texts[:60] for w in dc.words_of(t)]
    items = [(i, " ".join(rng.choices(filler, k=rng.randrange(14, 60)))) for i in range(30)]
    docs, planted = list(texts), set()
    for i, t in items:
        for share in (0.0, 0.1, 0.2):
            d = 10_000 + len(docs)
            docs.append((d, " ".join(rng.choices(filler, k=90) + edited(dc.words_of(t), share, rng, filler) + rng.choices(filler, k=70))))
            planted.add((d, i))
    for i in range(200):  # one passage in a large share of the documents
        docs.append((50_000 + i, " ".join(rng.choices(filler, k=30)) + " " + re.sub("[a-z]", lambda m: m[0].upper(), items[0][1])))
        planted.add((50_000 + i, 0))
    return items, docs, planted


def test_planted_copies_are_found_and_clean_documents_stay(spark, texts):
    items, docs, planted = items_and_docs(texts)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in dc.find_leaks(df, bench).collect()}
    assert len(planted & found.keys()) >= 0.98 * len(planted)
    assert found.keys() <= planted
    assert all(found[(50_000 + i, 0)]["score"] == 1 for i in range(200))
    kept = dc.remove_leaking(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in found}


def test_blocks_of_items_give_the_same(spark, texts, monkeypatch):
    items, docs, _ = items_and_docs(texts[:80])
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(tuple(r)[:3] for r in dc.find_leaks(df, bench).collect())
    monkeypatch.setattr(dc, "BLOCK_SEEDS", 2500)
    many = sorted(tuple(r)[:3] for r in dc.find_leaks(df, bench).collect())
    assert one == many


def test_rare_seeds_leave_every_item_some():
    items = dc.index_items([1, 2], ["a b c d e f", "a b c x y z"])
    df = np.array([100] * len(items.grams))
    kept = dc.keep_rare(items, df, 5)
    assert set(kept.item.tolist()) == {0, 1} and len(kept.at) < len(items.at)


def test_edited_copies_in_many_documents_and_in_small_tables(spark):
    """Every fifth word of an item changed, in 1 % of 3,000 documents and in one and two of 200."""
    rng = random.Random(3)
    item = [f"w{i}" for i in range(40)]
    copy = " ".join(f"x{i}" if i % 5 == 4 else w for i, w in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for n, copies in ((3000, 30), (200, 1), (200, 2)):
        docs = [(i, " ".join(f"f{rng.randrange(500)}" for _ in range(20)) + (f" {copy} and more" if i < copies else "")) for i in range(n)]
        rows = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(copies))
        assert all(abs(r["score"] - 0.7) < 0.02 and r["n_places"] == 1 for r in rows)


def test_words_in_common_bound_the_alignment():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(1, 15))] for _ in range(2))
        assert brute_align(a, b) <= 2 * dc.most_matches(np.array(a), np.array(b)) <= 2 * min(len(a), len(b))


def test_seeds_that_occur_nowhere_take_no_place_among_the_rare():
    items = dc.index_items([1], ["a b c d e f g h"])
    df = np.array([0, 0, 0, 100, 100, 100])
    assert len(dc.keep_rare(items, df, 5).at) == 2 and len(dc.mark_rare(items, df, 5).grams) == 3


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (4, "alpha beta gamma delta alpha beta"), (4, "alpha beta gamma delta alpha beta"),
                                   (None, "no id at all")], "item_id long, text string")
    rows = dc.find_leaks(odd, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in rows) == [(0, 0), (4, 4), (4, 4)]
    assert dc.find_leaks(empty, bench).count() == 0
    assert dc.find_leaks(odd, bench.where("false")).count() == 0
    assert dc.remove_leaking(odd, bench).count() == odd.count() - 2
    assert dc.remove_leaking(odd, bench).columns == odd.columns


def whole_scores(docs, items):
    """Best alignment of each item with each whole document, cell by cell."""
    return {(d, i): brute_align(dc.words_of(t), dc.words_of(x)) / (2 * len(dc.words_of(t))) for d, x in docs for i, t in items if dc.words_of(t)}


def test_equals_the_alignment_of_whole_documents(spark):
    rng = random.Random(11)
    filler = [f"f{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices([f"w{k}" for k in range(60)], k=rng.randrange(6, 50)))) for i in range(8)]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(rng.randrange(3)):
            words = dc.words_of(rng.choice(items)[1])
            a, b = sorted(rng.sample(range(len(words) + 1), 2))
            parts += [rng.choices(filler, k=rng.randrange(12)), edited(words[a:b], rng.choice([0, 0.15]), rng, filler)]
        docs.append((d, " ".join(w for p in parts for w in p)))
    want = whole_scores(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert all(want[k] >= v for k, v in got.items())  # a window never scores more than the document
    sure = {k for k, v in want.items() if v >= 0.5 and v >= 4 / len(dc.words_of(dict(items)[k[1]]))}
    assert got.keys() <= {k for k, v in want.items() if v >= 0.5}
    assert len(got.keys() & sure) >= 0.97 * len(sure) and len(sure) > 15
    assert sum(abs(want[k] - v) < 1e-9 for k, v in got.items()) >= 0.97 * len(got)


def test_parts_of_an_item_in_two_places_are_not_added_up(spark):
    item = [f"w{i}" for i in range(20)]
    swapped = item[7:13] + ["f1", "f2"] + item[:6] + [f"z{i}" for i in range(30)]
    long = [f"v{i}" for i in range(4001)]
    halves = long[2000:] + long[:2000]
    docs = [(1, " ".join(swapped)), (2, " ".join(["z"] * 40 + swapped)), (3, " ".join(halves)), (4, " ".join(["x"] * 9 + long))]
    bench = [(1, " ".join(item)), (2, " ".join(long))]
    got = sorted((r["doc_id"], r["item_id"], round(r["score"], 4), r["n_places"]) for r in dc.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect())
    assert got == [(3, 2, round(2001 / 4001, 4), 1), (4, 2, 1.0, 1)]


def test_seed_numbers_of_a_vast_vocabulary():
    text = " ".join(f"w{i}" for i in range(2_200_000))
    items = dc.index_items([1], [text])
    assert len(items.grams) == 2_200_000 - 2
    codes, place, seed = dc.seeds_in(items, ["a", *(f"w{i}" for i in range(2_199_000, 2_199_005)), "b"])
    assert place.tolist() == [1, 2, 3] and len(codes) == 7
