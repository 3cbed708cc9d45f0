import random
import re

from parley.llm import licenses

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text):
    w = words_of(text)
    return [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]


def distance(a, b):
    """Fewest edits between ``a`` and any part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def edited(text, k, rng):
    t = list(text)
    for _ in range(k):
        i = rng.randrange(1, len(t) - 1)
        t[i:i + 1] = rng.choice([[], [rng.choice("abcxyz")], [t[i], rng.choice("abcxyz")]])
    return "".join(t)


def test_query_base(spark, texts):
    extra = [(9001, "CC-BY cc by cc  BY, all rights\nreserved"), (9002, "ccby cc byx accc by"), (9003, "cc by by cc by")]
    rows = licenses.scan(spark.createDataFrame(texts + extra, "doc_id long, text string")).collect()
    want = dict(texts + extra)
    for r in rows:
        places = brute_base(want[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(words_of(want[r["doc_id"]])), len(places))
        assert (r["first_word"], r["last_word"]) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) or not places


def test_edited_notices_are_found_and_only_they():
    rng, scan = random.Random(3), licenses.Scanner()
    for number, (label, notice, k, *_) in enumerate(scan.notices):
        for edits in range(k + 3):
            for _ in range(4):
                body = edited(notice, edits, rng)
                text = f"alpha beta gamma {body} delta epsilon"
                joined = " ".join(words_of(text))
                least = distance(notice, joined)
                hit = [m for m in scan.matches(joined) if m[0] == number]
                assert bool(hit) == (least <= k), (notice, body)
                if hit:
                    assert hit[0][3] == least


def test_spans_point_into_the_text():
    text = "Xx. LICENSED under the  Apache Licence, Version 2.0!! yy"
    (hit,) = [h for h in licenses.Scanner().scan(text)[2] if h.label == "apache-2.0"]
    assert text[hit.start:hit.end] == "LICENSED under the  Apache Licence, Version 2.0" and hit.edits == 1 and hit.first_word == 1


def test_repeats_stay_linear():
    n, _, hits = licenses.Scanner().scan("released under the mit license. " * 400)
    assert n == 2000 and len([h for h in hits if h.label == "mit"]) == 400


def test_odd_rows(odd, empty):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["score"] == 0 and r["labels"] == "" for r in rows)
    assert licenses.scan(empty).count() == 0
