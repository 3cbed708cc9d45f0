import itertools
import random
import re
from collections import Counter

from parley.llm import filter_audit as fa


def plain_part(counts):
    """Rows of a part by running every order over the masks."""
    out = {}
    total = Counter()
    for order in itertools.permutations(range(5)):
        before = 0
        for step, f in enumerate(order, 1):
            gone = [sum(c[i] for m, c in counts.items() if not m & before and m >> f & 1) for i in range(3)]
            late = sum(c[0] for m, c in counts.items() if m & before and m >> f & 1)
            before |= 1 << f
            kept = sum(c[0] for m, c in counts.items() if not m & before)
            total[f] += gone[0]
            out["".join("ABCDE"[x] for x in order), step] = (kept, gone[0], late, counts.get(1 << f, (0,))[0], *gone[1:], f)
    return {k: (*v[:-1], total[v[-1]]) for k, v in out.items()}


def test_diagram_equals_running_every_order():
    rnd = random.Random(3)
    for fill in (0.0, 0.1, 0.6, 1.0):
        counts = {m: (n := rnd.randint(1, 9), rnd.randint(0, n), rnd.randint(0, n)) for m in range(32) if rnd.random() < fill}
        got = {r[:2]: r[2:] for r in fa.audit_part(counts)}
        assert got == plain_part(counts)


def test_swaps_visit_every_order_once_and_keep_diagrams_small():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for at in fa.swap_walk(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(n))))
    # one filter decides: equal subdiagrams are one node a level in any order
    d = fa.Diagram({m: (1,) if m & 1 else (0,) for m in range(32)}, 5)
    for at in fa.swap_walk(5):
        assert sum(map(len, d.levels)) <= 9
        d.swap(at)


def plain_mask(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search(r"[#$%&*|]", t))]


def test_masks_of_texts(texts):
    rnd = random.Random(1)
    made = ["".join(rnd.choice(" aB\n \x1cé#\x0b") for _ in range(rnd.randint(0, 500))) for _ in range(300)]
    for t in [t or "" for _, t in texts] + made + ["A" * 3 + "a" * 97, "A" * 4 + "a" * 96, "w " * 200]:
        assert [bool(fa.text_mask(t) >> i & 1) for i in range(4)] == plain_mask(t)


def test_copies_labels_and_odd_tables(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    want = sorted(((i, i is not None and i > least[t or ""]) for i, t in rows), key=repr)
    got = fa.failures(odd).collect()
    assert sorted(((r["id"], bool(r["mask"] & 16)) for r in got), key=repr) == want
    assert {r["part"] for r in got} == {"l"}
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    counted = fa.mask_counts(fa.failures(odd), labels).selectExpr("sum(n)", "sum(good)", "sum(toxic)").first()
    assert tuple(counted) == (len(rows), 1, 3)
    out = fa.audit_filters(odd.selectExpr("doc_id", "text", "cast(null as string) as lang"), labels)
    assert out.count() == 600 and {r["part"] for r in out.select("part").distinct().collect()} == {""}
    assert fa.audit_filters(empty, labels).count() == 0
    assert fa.audit_filters(odd, labels.where("false")).selectExpr("sum(good_lost + toxic_lost)").first()[0] == 0
