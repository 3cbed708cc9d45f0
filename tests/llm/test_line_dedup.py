from collections import Counter
import hashlib

import numpy as np
import pytest

from parley.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(rows, min_docs, min_chars, keep):
    """(id, text left, lines, dropped) of each row, by counting all keys."""
    docs = [(i, "" if t is None else t) for i, t in rows]
    seen = Counter(k for _, t in docs for k in {key(x) for x in t.split("\n")})
    shared = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    first = {}
    for i, t in docs:
        place = (i is not None, i or 0, hashlib.sha256(t.encode()).hexdigest())
        for n, x in enumerate(t.split("\n")):
            first[key(x)] = min(first.get(key(x), (True, 1 << 60, "", 0)), (*place, n))
    out = []
    for i, t in docs:
        lines = t.split("\n")
        me = (i is not None, i or 0, hashlib.sha256(t.encode()).hexdigest())
        left = [x for n, x in enumerate(lines) if key(x) not in shared or keep == "first" and first[key(x)] == (*me, n)]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def made(rng, n=120):
    pool = [f"Shared line {i}" for i in range(12)] + ["", "  ", "é", "ab", "x"]
    rows = []
    for i in range(n):
        lines = [str(rng.choice(pool)) if rng.random() < 0.5 else f"own {i} {k}" for k in range(rng.integers(0, 9))]
        lines = [x.upper() if rng.random() < 0.2 else f" {x}\t" if rng.random() < 0.2 else x for x in lines]
        rows.append((i, "\n".join(lines) if rng.random() < 0.95 else None))
    return rows + rows[:7] + [(None, "Shared line 1\nno id"), (None, "Shared line 1\nno id"), (900, "a\n" * 50_000 + "Shared line 2")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": -1}, {"filter_bits": 1 << 17}, {"filter_bits": 40 << 17, "broadcast_bytes": -1}])
@pytest.mark.parametrize("limits", [(2, 1), (10, 1), (3, 0), (3, 5)])
def test_equals_a_count_of_all_keys(spark, keep, how, limits):
    if len(how) == 1 and limits != (3, 5):
        pytest.skip("the other limits are covered by the plain and the joined path")
    rows = made(np.random.default_rng(len(how)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = ld.drop_shared_lines(docs, *limits, keep=keep, **how)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, *limits, keep)


def test_filter_misses_no_key_seen_twice_and_clears_most_others(spark):
    rows = [(i, "\n".join([f"own {i} {k}" for k in range(50)] + [f"pair {i // 2}"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(9)
    held = ld.twice_filter(docs, 1, 2)
    keys = [f"pair {i}".encode() for i in range(300)]
    assert ld._suspected(keys, held) == keys
    alone = [f"own {i} {k}".encode() for i in range(600) for k in range(50)]
    assert len(ld._suspected(alone, held)) < 0.01 * len(alone)


def test_a_full_filter_changes_no_result(spark, monkeypatch):
    rows = made(np.random.default_rng(5))
    monkeypatch.setattr(ld, "twice_filter", lambda *_: np.full((1, ld.PAGE_BITS // 8), 255, dtype=np.uint8))
    got = ld.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 3, 1, "none")


def test_odd_tables(spark, odd, empty):
    docs = odd.selectExpr("*", "4 as n_lines", "5 as id", "6 as gone", "7 as key")
    out = ld.drop_shared_lines(docs, 2)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    got = {(r["doc_id"], r["text"], r["n_dropped"]) for r in out.collect()}
    assert {(1, "", 0), (2, "", 0), (5, "", 1), (6, "", 1), (3, "  \n\t ", 0)} <= got
    assert sorted(out.select("id", "gone", "key").distinct().collect()) == [(5, 6, 7)]
    assert ld.drop_shared_lines(empty, 2).collect() == []
    assert ld.drop_shared_lines(docs, 2, broadcast_bytes=-1).exceptAll(out).isEmpty()
    with pytest.raises(ValueError):
        ld.drop_shared_lines(docs, 1)
