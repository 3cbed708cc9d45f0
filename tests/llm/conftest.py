import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the small driver table."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long = "alpha beta gamma delta " * 20_000
    rows = [(1, None, "x"), (2, "", "y"), (3, "  \n\t ", None), (4, long, "z"), (5, "same words here", "q"), (5, "same words here", "q"),
            (6, "same words here", "q"), (None, "no id at all", None), (None, None, None), (7, "x" * 50_000, "z"), (8, "é \u0000 \U0001F600 ñ", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string").selectExpr(
        "doc_id", "text", "score", "'a' as rejected_by", "1 as fingerprint", "2 as n_words", "3 as fp", "true as held_out", "'l' as lang", "0 as toxicity")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
