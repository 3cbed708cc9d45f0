import re

from parley.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered),
            sum(a == b for a, b in zip(words, words[1:])))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_same"]


def test_figures_against_brute_force(spark, texts, odd):
    extra = [(10_001, "a b c d e f g h " * 3), (10_002, "a " * 40), (10_003, "x\nx\n \n\ny\nx"), (10_004, "a b c d e f g h i a b c d e f g h"), (10_005, "")]
    df = spark.createDataFrame(texts + extra, "doc_id long, text string")
    want = dict(texts + extra)
    for r in quality.figures(df, NAMES).collect():
        assert tuple(r[n] for n in NAMES) == brute(want[r["doc_id"]]), r["doc_id"]
    for r in quality.figures(odd.drop("n_words"), NAMES).collect():
        assert tuple(r[n] for n in NAMES) == brute(r["text"])


def test_verdicts_do_not_depend_on_the_order(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    one = {r["doc_id"]: r["rejected_by"] for r in quality.cascade(df).collect()}
    two = {r["doc_id"]: r["rejected_by"] for r in quality.cascade(df, quality.RULES[::-1]).collect()}
    assert {k for k, v in one.items() if v} == {k for k, v in two.items() if v}
    for d, t in texts:
        n, chars, sym, _, rep, same = brute(t)
        if n < 20 or 100 * rep > 30 * n or 10 * sym > n or 10 * same > 3 * n:
            assert one[d], d


def test_order_by_rejection_per_cost():
    rules = quality.RULES[:3]
    got = quality.order_rules(rules, {rules[0].name: (1.0, 0.1), rules[1].name: (0.1, 0.1), rules[2].name: (1.0, 0.9)})
    assert [r.name for r in got] == [rules[1].name, rules[2].name, rules[0].name]


def test_odd_rows(odd, empty):
    out = quality.judge(odd)
    assert sorted(out.columns) == sorted(odd.columns) and out.count() == odd.count()
    assert all(r["rejected_by"] for r in out.where("doc_id in (1, 2, 3)").collect())
    assert quality.judge(empty).count() == 0


def test_later_rules_read_open_rows_only(spark):
    df = spark.createDataFrame([(1, "short")], "doc_id long, text string")
    text = quality.cascade(df)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in text and "MapInArrow" not in text
