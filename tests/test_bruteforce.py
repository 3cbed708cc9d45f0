"""Queries without a SQL oracle, checked against straightforward Python on small driver tables."""

import __spark_entry__ as entry
from conftest import SF01
from parley.sources.tables import read_table


def _edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_wer_turns_bruteforce(spark):
    rows = read_table(spark, SF01, "conversations").select("conv_id", "turn", "text").collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.turn, r.text))
    edits = words = pairs = 0
    for turns in by.values():
        turns.sort()
        for (_, a), (_, b) in zip(turns, turns[1:]):
            ra, hb = a.split(), b.split()
            edits += _edit(ra, hb)
            words += len(ra)
            pairs += 1
    got = entry.queries()["m5_wer_turns"](spark, SF01).first()
    assert (got.edits, got.ref_words, got.n_pairs) == (edits, words, pairs)
    assert got.wer == round(edits / words, 6)


def test_aligned_labels_of_every_piece(spark):
    """A word's first piece has the id of its tag, its other pieces the id of the inside tag; special places -100."""
    from parley.operators import spans
    from parley.plans.catalog import _bio_rows
    ids = {name: n for n, name in enumerate(spans.LABELS)}
    inside = {name: ids[name.replace("B-", "I-")] for name in ids}
    got = {}
    for r in entry.queries()["b11_align_labels"](spark, SF01).collect():
        got.setdefault(r.row_id, []).append((r.i, r.label_id))
    for r in _bio_rows(spark, SF01).collect():
        pieces = [(ids[tag], [inside[tag]] * (-(-len(word) // 4) - 1)) for word, tag in zip(r.tokens, r.tags)]
        want = [-100] + [x for first, more in pieces for x in (first, *more)] + [-100]
        assert sorted(got[r.row_id]) == list(enumerate(want))
