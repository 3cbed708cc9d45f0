"""Model training and batch scoring.

The reference fine-tunes transformers and runs ONNX sessions; here the guardrail is a Spark ML
pipeline trained where the data lives, batch inference goes through ``predict_batch_udf`` (Arrow
batches, model loaded once per Python worker), and decoding steps stay native array expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import LABELS


def train_guardrail(train: DataFrame, text_col: str = "text", label_col: str = "label", num_features: int = 1 << 18,
                    max_iter: int = 50, reg: float = 0.01):
    """G1: TF-IDF + logistic regression guardrail (SAFE 0 / UNSAFE 1), fitted on a DataFrame."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"(?U)\W+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[tok, tf, idf, lr]).fit(train.withColumn(label_col, F.col(label_col).cast("double")))


def score_guardrail(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """G2 + D11: ``p_unsafe`` = probability of class 1, ``is_unsafe = p_unsafe >= threshold``."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    p = vector_to_array("probability")[1]
    keep = [c for c in df.columns]
    return out.select(*keep, p.alias("p_unsafe"), (p >= threshold).alias("is_unsafe"))


def linear_head_weights(dim: int, n_out: int, seed: int = 7) -> list[list[float]]:
    """Deterministic test weights for a linear head (a stand-in for a trained model's last layer)."""
    import math
    return [[round(math.sin((o + 1) * (j + 1) * 0.37 + seed) * 0.5, 6) for j in range(dim)] for o in range(n_out)]


def linear_logits(vec: Column, weights: Sequence[Sequence[float]]) -> list[Column]:
    """D10 input: one logit per output row of ``weights`` as native dot products (no Python)."""
    outs = []
    for w in weights:
        wl = F.array(*[F.lit(float(x)) for x in w])
        outs.append(F.aggregate(F.zip_with(vec, wl, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x))
    return outs


def batch_predict(df: DataFrame, input_col: str, make_predict: Callable, out_type: str = "array<double>",
                  batch_size: int = 1024, input_shape: Sequence[int] | None = None) -> DataFrame:
    """Pluggable batch model scorer. ``make_predict()`` runs once per Python worker and returns a
    function ``np.ndarray[batch, ...] -> np.ndarray[batch, ...]`` (any backend: ONNX, Torch, numpy)."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    rtype = ArrayType(DoubleType()) if out_type == "array<double>" else out_type
    shape = list(input_shape) if input_shape else [df.select(F.size(input_col)).first()[0]]
    udf = predict_batch_udf(make_predict, return_type=rtype, batch_size=batch_size, input_tensor_shapes=[shape])
    return df.withColumn("prediction", udf(F.col(input_col)))


def numpy_linear_head(weights: Sequence[Sequence[float]]) -> Callable:
    """A ``make_predict`` for ``batch_predict``: two-class softmax over a fixed linear head."""
    def make():
        import numpy as np
        w = np.asarray(weights, dtype=np.float64).T

        def predict(x):
            z = np.asarray(x, dtype=np.float64) @ w
            z = z - z.max(axis=1, keepdims=True)
            e = np.exp(z)
            return e / e.sum(axis=1, keepdims=True)
        return predict
    return make


def frames(vec: Column, width: int, n_frames: int | None = None) -> Column:
    """Cut a flat score vector into consecutive rows of ``width`` scores (frames or tokens); the last one is
    shorter where the width does not divide the size."""
    n = F.ceil(F.size(vec) / width) if n_frames is None else F.lit(n_frames)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(vec, i * width + 1, width))


def argmax_rows(rows: Column) -> Column:
    """First index of the maximum in each row (numpy ``argmax``)."""
    return F.transform(rows, lambda r: F.array_position(r, F.array_max(r)) - 1)


def ids_to_labels(ids: Column, labels: Sequence[str] = LABELS) -> Column:
    """Id -> label; ids outside the label set -> ``O``."""
    arr = F.array(*[F.lit(x) for x in labels])
    return F.transform(ids, lambda i: F.coalesce(F.get(arr, i), F.lit("O")))


def ctc_greedy(ids: Column, vocab: Sequence[str], blank: int = 0, word_delimiter: str | None = None,
               group_tokens: bool = True) -> Column:
    """Collapse repeated ids (unless ``group_tokens`` is False), drop the blank id, map ids to
    characters (``word_delimiter`` -> space) and join."""
    kept = F.filter(ids, lambda x, i: (i == 0) | (x != F.get(ids, i - 1))) if group_tokens else ids
    kept = F.filter(kept, lambda x: x != blank)
    chars = [(" " if (word_delimiter is not None and v == word_delimiter) else v) for v in vocab]
    arr = F.array(*[F.lit(c) for c in chars])
    return F.array_join(F.transform(kept, lambda x: F.coalesce(F.get(arr, x), F.lit(""))), "")


def align_labels(word_ids: Column, tags: Column, label2id: dict[str, int] | None = None) -> Column:
    """Sub-token labels: special tokens (null word id) -> -100; the first piece of a word keeps its
    tag id; later pieces of a ``B-x`` word get ``I-x``."""
    l2i = label2id or {lab: i for i, lab in enumerate(LABELS)}
    keys = F.array(*[F.lit(k) for k in l2i])
    vals = F.array(*[F.lit(v) for v in l2i.values()])
    m = F.map_from_arrays(keys, vals)

    def one(w, i):
        tag = F.get(tags, w)
        prev = F.when(i > 0, F.get(word_ids, i - 1))
        cont = prev.isNotNull() & (prev == w)
        inside = F.when(tag.startswith("B-"), F.concat(F.lit("I-"), F.substring(tag, 3, 1 << 20))).otherwise(tag)
        return F.when(w.isNull(), F.lit(-100)).when(cont, F.element_at(m, inside)).otherwise(F.element_at(m, tag))
    return F.transform(word_ids, one)
