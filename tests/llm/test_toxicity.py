import numpy as np

from parley.llm import queries, toxicity
from parley.llm.common import fold


def brute_kernel(s, t, p=3, decay=0.6):
    """All pairs of equal subsequences of length p."""
    from itertools import combinations
    total = 0.0
    for a in combinations(range(len(s)), p):
        for b in combinations(range(len(t)), p):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_against_all_subsequences():
    words = ["idiot", "idixot", "iidoit", "abc", "abcabc", "a", "moron", "ormon"]
    for s in words:
        for t in words:
            got = toxicity.subsequence_kernel(toxicity._codes([s]), toxicity._codes([t]))[0]
            assert abs(got - brute_kernel(s, t)) < 1e-9, (s, t)
    padded = toxicity.subsequence_kernel(toxicity._codes(["abcabc", "idiot"]), toxicity._codes(["abc", "idixot"]))
    assert np.allclose(padded, [brute_kernel("abcabc", "abc"), brute_kernel("idiot", "idixot")])


def plain(s, t):
    norm = (brute_kernel(s, s) * brute_kernel(t, t)) ** 0.5
    return brute_kernel(s, t) / norm if norm else 0.0


def test_pairs_are_those_of_the_plain_kernel(texts):
    """No pair at or above the floor is missed or changed, whatever letters it shares."""
    rng = np.random.default_rng(2)
    marks = ["idiot", "loser", "stupid", "r\u00e9\u00eaou", "abc", "aaaa"]
    words = sorted({w for _, t in texts[:15] for w in toxicity.words_of(t)})[:150] + ["idoit", "idxixot", "lxosxer", "ixdxixoxt", "", "a", "ab", "abc", "aaaaaaa"]
    words += ["".join(rng.permutation(list(w))) for w in marks for _ in range(5)]
    words = [w for w in words if len(w) <= 14]
    kernel = toxicity.Kernel(marks)
    for floor in (0.0, 0.3, 0.5):
        want = {(i, k): v for i, w in enumerate(words) for k, m in enumerate(marks) if (v := plain(w, m)) >= max(floor, 1e-12)}
        got = {(i, k): v for i, k, v in zip(*(x.tolist() for x in kernel.pairs(words, floor)))}
        assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    assert np.allclose(kernel.matrix(marks), [[plain(a, b) for b in marks] for a in marks])


def test_inserted_letters_stay_above_the_floor():
    rng = np.random.default_rng(4)
    marks = ["idiot", "loser", "stupid", "worthless", "pathetic", "moron", "clown", "trash"]
    kernel = toxicity.Kernel(marks)
    for inserted, least in ((1, 0.99), (2, 0.8)):
        forms = []
        for m in marks:
            for _ in range(25):
                w = list(m)
                for _ in range(inserted):
                    w.insert(int(rng.integers(1, len(w))), "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)])
                forms.append("".join(w))
        assert len(set(kernel.pairs(forms)[0].tolist())) >= least * len(forms)


def test_gaps_and_signs_are_tolerated():
    pool = toxicity.Pool(["idiot", "worthless"])
    plain, other = pool.values(["you idiot"])[0], pool.values(["you kind person"])[0]
    assert plain[0] > 0.99 and other[0] == 0
    for text in ("you i.d.i.o.t", "you i d i o t", "you idi*ot", "you idixot", "you iddiot", "YOU IDIOT!!"):
        assert pool.values([text])[0][0] > 0.5 ** toxicity.POWER, text


def test_spaced_words_before_any_sign_alone_in_a_task():
    forms = ("idiot", "i d i o t", "i.d.i.o.t", "i. d. i. o. t", "i-d-i-o-t", "i * d * i * o * t", "i\nd\ni\no\nt", "(i d i o t)", "idi*ot")
    for form in forms:
        for end in ("", ".", "!", "?", ",", "?!", " go", ". go", "! go", "? go", ", go", ".\nGo"):
            alone = toxicity.Pool(["idiot"]).values([f"you are an {form}{end}"])[0][0]
            assert alone > 0.99, (form, end)


def test_tokens_of_sentences_are_those_of_the_text(texts):
    for t in [t for _, t in texts[:200]] + ["so w.e. i d i o t! a b. c\nd e.f. g?!x y z...", "don't u r a, e.g. i. d?\u2028i o t"]:
        whole = toxicity.joined(t)
        assert toxicity.tokens_of(t) == [w for x in toxicity._SENTENCE(whole) for w in toxicity._TOKEN(x)]


def test_sentences_are_pooled_by_their_nearest_word():
    pool = toxicity.Pool(["idiot"])
    assert np.isclose(pool.values(["idiot idiot idiot."])[0][0], 1)
    assert np.isclose(pool.values(["idiot. idiot!\nidiot"])[0][0], 3)


def test_cache_starts_over(monkeypatch, texts):
    some = [t for _, t in texts[:50]]
    want = toxicity.Pool(["idiot", "moron"]).values(some)
    monkeypatch.setattr(toxicity, "CACHE_SIZE", 10)
    small = toxicity.Pool(["idiot", "moron"])
    assert all(np.array_equal(small.values([t])[0], w) for t, w in zip(some, want))


def test_query_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.85
    bad = [r["predicted"] for r in rows if not r["held_out"] and labels.get(r["doc_id"]) == 1]
    assert np.mean(bad) > 0.6


def test_odd_rows(spark, odd, empty):
    toxic = spark.createDataFrame([(d, 1) for d in range(100, 110)] + [(d, 0) for d in range(110, 130)] + [(100, 0), (None, 1), (111, None)],
                                  "doc_id long, toxic int")
    docs = spark.createDataFrame([(d, "an idiot" if d < 110 else "a kind word") for d in range(100, 130)], "doc_id long, text string")
    model = toxicity.train(docs, toxic)
    assert "idiot" in model.landmarks
    out = toxicity.score(odd, model)
    assert out.columns.count("score") == 1 and out.count() == odd.count()
    rows = out.collect()
    assert all(r["score"] < 0.5 for r in rows)
    hit = toxicity.score(spark.createDataFrame([(1, "what an idi*ot")], "doc_id long, text string"), model).first()
    assert hit["score"] > 0.5
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(empty, toxic)
    assert none.landmarks == () and {r["score"] for r in toxicity.score(odd, none).collect()} == {0.0}
