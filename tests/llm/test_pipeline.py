import re

import corpus_pipeline
import numpy as np
from parley.llm import decontaminate, quality, simhash, toxicity
from .test_bpe import ids_of
from .test_quality import brute
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def stage(number, spark, docs):
    return corpus_pipeline.STAGES[number][1](spark, docs, SF)


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage on its own input: what it keeps is what a plain version of its rule keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}

    def reread(out, k):
        out.write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    one = reread(stage(0, spark, docs), 0)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"))
    pool = toxicity.Pool(list(model.landmarks))
    want = {d for d, t in now.items() if model.score(pool.values([t]))[0] < 0.5}
    now = {r["doc_id"]: r["text"] for r in one.collect()}
    assert one.columns == columns and set(now) == want

    two = reread(stage(1, spark, one), 1)

    def good(t):
        n, chars, sym, dup, rep, same = brute(t)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in t.split("\n"))
        upper = sum("A" <= c <= "Z" for c in t)
        return not (n < 20 or 10 * sym > n or 10 * upper > 3 * chars or chars < 2 * n or chars > 15 * n or 2 * dup > lines
                    or 10 * same > 3 * n or 100 * rep > 30 * n)

    want = {d for d, t in now.items() if good(t)}
    now = {r["doc_id"]: r["text"] for r in two.collect()}
    assert two.columns == columns and set(now) == want

    three = reread(stage(2, spark, two), 2)
    label = brute_components({d: brute_fingerprint(t) for d, t in now.items()})
    now = {r["doc_id"]: r["text"] for r in three.collect()}
    assert three.columns == columns and set(now) == {d for d, c in label.items() if d == c}

    four = reread(stage(3, spark, three), 3)
    bench = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {d for d, t in now.items() if any(f" {' '.join(b)} " in f" {' '.join(decontaminate.words_of(t))} " for b in bench)}
    now = {r["doc_id"]: r["text"] for r in four.collect()}
    assert four.columns == columns and held.isdisjoint(now) and len(three.collect()) - len(now) <= len(held) + 1

    five = stage(4, spark, four).collect()
    assert {r["doc_id"]: np.array(r["ids"], dtype="<u4").tobytes() for r in five} == {d: ids_of(t) for d, t in now.items()}


def test_odd_rows_through_every_stage(spark, odd, empty):
    for number in range(4):
        out = stage(number, spark, odd)
        assert out.columns == odd.columns and out.count() <= odd.count()
        assert stage(number, spark, empty).count() == 0
    assert corpus_pipeline.tokenize(spark, odd, SF).count() == odd.count()
    assert quality.RULES and simhash.RADIUS == 3
