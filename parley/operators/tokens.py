"""Tokenisation with character offsets (B1, B2).

``doc_frame`` numbers the text rows (``row``) and spreads them by that number once. Tokens and their offsets are
arrays of the text's row (``with_tokens``), so no token is sorted or shuffled to learn its place; ``explode`` gives
the long form. Windows, aggregates and joins on the row (span islands, masking) get the few tokens inside entities.
Groups are rows of the table, whatever their ids: repeated or null ids are rows of their own, and no id can gather
more than one text in a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import regex as rx
from ..functions.text import normalize_ws
# Python's str semantics: \w = letters, numbers, underscore; \s = str.isspace() characters.
WORD, SPACE = rx.WORD_CLASS, rx.SPACE_CLASS
PIECES = f"(?U)[{WORD}]+|[^{WORD}{SPACE}]|[{SPACE}]+"
#: a token with the whitespace before it
LED_TOKEN = f"(?U)[{SPACE}]*+(?:[{WORD}]++|[^{WORD}{SPACE}])"
#: the characters of SPACE, the blank first
SPACES = " " + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")


def doc_frame(df: DataFrame, id_col: str, text_col: str, partitions: int | None = None) -> DataFrame:
    """``row, doc_id, text``: numbered text rows, spread by their number (one exchange); downstream operators
    reuse it. The number is the row's place in ``df``, so ``df`` must give its rows in the same order when a task is
    repeated: a scan with filters and projections does, a shuffled result should be written or checkpointed first."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # without a number AQE sizes the partitions to the data
    return rows.repartition(partitions, "row") if partitions else rows.repartition("row")


def row_key(df: DataFrame) -> list[str]:
    """The columns that name a text row: ``row, doc_id`` of ``doc_frame``, else ``doc_id`` alone (then unique)."""
    return [c for c in ("row", "doc_id") if c in df.columns]


def running_totals(lengths: Column, once: bool = False) -> Column:
    """The running totals of each row's array of lengths, in one pass over them. ``once``: the optimizer copies them into no
    other expression (an expression over a Python function would else be written out wherever it is used, lambdas too)."""
    def totals(rows: pa.Array) -> pa.Array:
        upto = np.concatenate([[0], np.cumsum(rows.flatten().to_numpy(), dtype=np.int64)])
        sizes = pc.list_value_length(rows).to_numpy()
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        own = upto[1:] - np.repeat(upto[bounds[:-1]], sizes)
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(own, pa.int32()))

    udf = F.arrow_udf(totals, "array<int>")
    return (udf.asNondeterministic() if once else udf)(lengths)


def without_lead(piece: Column) -> Column:
    """The token of a ``LED_TOKEN`` piece."""
    return F.ltrim(piece, F.lit(SPACES))


def with_pieces(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pieces`` (its tokens, each with the whitespace before it) and ``lens`` (their lengths)."""
    # nothing after the last token: a run of whitespace at the end would be tried from each of its characters
    x = docs.withColumn("pieces", F.regexp_extract_all(F.rtrim(F.coalesce("text", F.lit("")), F.lit(SPACES)), F.lit(LED_TOKEN), 0))
    return x.withColumn("lens", F.transform("pieces", F.length))


def with_tokens(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pieces`` and ``ends``, the 0-based offset after each token."""
    return with_pieces(docs).withColumn("ends", running_totals(F.col("lens"))).drop("lens")


def token_columns(x: Column) -> list[Column]:
    """``token, s, e`` of a struct with ``pieces, ends``."""
    token = without_lead(x["pieces"])
    return [token.alias("token"), (x["ends"] - F.length(token)).alias("s"), x["ends"].alias("e")]


def tokens_with_offsets(docs: DataFrame) -> DataFrame:
    """B1: ``\\w+`` runs and single non-space symbols with 0-based half-open offsets.

    Output: the row key, ``ti (0-based token index), token, s, e``. The text is cut into tokens, each with the
    whitespace before it; these pieces tile it from the start, so the running totals of their lengths are the ends of
    the tokens.
    """
    key = row_key(docs)
    x = with_tokens(docs).select(*key, F.posexplode(F.arrays_zip("pieces", "ends")).alias("ti", "x"))
    return x.select(*key, "ti", *token_columns(F.col("x")))


def whitespace_tokens(text) -> "F.Column":
    """B2: Python ``str.split()``: split on whitespace runs, no empty tokens."""
    n = normalize_ws(text)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.split(n, " "))
