"""Scoring a labelled dataset end to end (S1 -> N1-N8 -> R1-R8 -> M1/M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources import calls as call_src
from . import metrics, rules


def evaluate_dataset(payloads: DataFrame, lexicon: dict | None = None, role: str = "operator",
                     debug_metric: str | None = None, max_mismatches: int = 50) -> dict[str, DataFrame]:
    """``payloads``: one VARIANT row per labelled item (``read_payload_array``). Returns the
    normalisation rejects, the long scores, the JSON response per call, the per-metric and overall agreement with the expected
    scores (ROLLUP, overall rounded to 4 decimals) and at most ``max_mismatches`` disagreements
    (optionally one metric)."""
    from .nested import score_nested

    # items may repeat a call id: a number of its own, written once, keeps predictions and expectations paired
    items = cut_lineage(payloads.withColumn("item", F.monotonically_increasing_id().cast("string")))
    calls, rejects = call_src.normalize_payloads(items, keep=["item"])
    # each labelled item holds one whole call and is scored on its own, inside its row
    by_item = score_nested(calls.withColumn("call_id", F.col("item")), lexicon, role=role).withColumnRenamed("call_id", "item")
    wide = by_item.join(calls.select("item", "call_id", "dataset_id"), "item")
    scores = rules.to_long(wide.withColumn("call_id", F.struct("item", "call_id"))).select(
        "call_id.item", "call_id.call_id", "metric", "score", "probability", "reasoning", "evidence_snippet")
    expected = call_src.expected_scores(items, keep=["item"])
    keys = ("item", "metric")
    # K4: one response record per item, echoing the dataset id when the payload carried one
    return {"rejects": rejects, "scores": scores.drop("item"), "responses": rules.results_json(wide, F.col("dataset_id")),
            "accuracy": metrics.accuracy(scores, expected, keys),
            "mismatches": metrics.mismatches(scores, expected.drop("call_id"), debug_metric, max_mismatches, keys).drop("item")}
