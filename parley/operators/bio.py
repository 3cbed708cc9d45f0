"""BIO corpora helpers (B4-B6, B11): span corpora to BIO rows, sub-sequence tagging, tag overlay and
sub-token alignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import all_tags, tag_arrays
from .tokens import without_lead


def spans_corpus_to_bio(df: DataFrame, id_col: str = "row_id", text_col: str = "text",
                        entities_col: str = "entities") -> DataFrame:
    """Span-annotated rows (``entities ARRAY<STRUCT<start,end,label>>``) -> ``row_id, tokens, tags, text``.

    Tokens and tags are made inside the row (B1, B3), so rows need no key and nothing is shuffled.
    """
    ents = F.transform(entities_col, lambda x, i: F.struct(x["start"].cast("int").alias("s"), x["end"].cast("int").alias("e"),
                                                           i.cast("int").alias("eo"), x["label"].alias("label")))
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), ents.alias("tags"))
    return tag_arrays(src, ["tags"]).select(F.col("doc_id").alias(id_col), F.transform("pieces", without_lead).alias("tokens"),
                                            all_tags("tags").alias("tags"), "text")


def match_bio(tokens: Column, entity_tokens: Column, label: str) -> Column:
    """Tag the first exact occurrence of ``entity_tokens`` inside ``tokens`` (B-, then I-); else all O."""
    n, k = F.size(tokens), F.size(entity_tokens)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))),
                      lambda i: (k > 0) & (i + k - 1 <= n) & (F.slice(tokens, i, k) == entity_tokens))
    first = F.get(starts, 0)
    return F.transform(tokens, lambda t, j: F.when(first.isNull(), F.lit("O"))
                       .when(j + 1 == first, F.lit(f"B-{label}"))
                       .when((j + 1 > first) & (j + 1 < first + k), F.lit(f"I-{label}"))
                       .otherwise(F.lit("O")))


def overlay(base: Column, add: Column) -> Column:
    """Non-O tags of ``add`` win over ``base``."""
    return F.zip_with(base, add, lambda b, a: F.when(a != "O", a).otherwise(b))


def subword_ids(tokens: Column, piece_chars: int = 4) -> Column:
    """Word ids of a simple sub-word split (each word cut into pieces of ``piece_chars`` characters),
    framed by two special positions (null), as a stand-in for a model tokenizer's ``word_ids()``."""
    per_word = F.transform(tokens, lambda w, i: F.array_repeat(i, F.greatest(F.ceil(F.length(w) / piece_chars), F.lit(1)).cast("int")))
    inner = F.flatten(per_word)
    return F.concat(F.array(F.lit(None).cast("int")), inner, F.array(F.lit(None).cast("int")))
