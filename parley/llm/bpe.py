"""Operator 3: byte-level BPE encoding and decoding through a sentencepiece model built from ranks.

The model is serialised directly from a rank vocabulary: each token's bytes become a piece over 256
stand-in characters, its score is the negative rank, normalisation is the identity. Nothing is
trained. A text is first cut into pre-tokens by ``pattern``; every distinct pre-token is encoded
once per block by sentencepiece and kept in a bounded cache; ids are decoded by the inverse mapping.

Defined results: a null text encodes as the empty text (no ids); texts of any length are encoded
whole; repeated rows give repeated results; only the id and text columns are read, so further
columns of any name are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece as spm
from pyspark.sql import DataFrame

from .common import blocks, texts_of

VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CACHE_SIZE = 200_000

_STAND_IN = {b: chr(0x100 + b) for b in range(256)}  # no white space among them
_SEP = "￿"


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def model_proto(tokens: list[bytes]) -> bytes:
    """Serialised sentencepiece BPE model; piece id = rank + 1 (id 0 is the unknown piece)."""
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for rank, tok in enumerate(tokens):
        text = tok.decode("latin-1").translate(_STAND_IN).encode()
        pieces.append(_field(1, _field(1, text) + _field(2, -float(rank)) + _field(3, 1)))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, 0) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


def _ranges(category: str, below: int) -> str:
    """Character-class ranges of a general category (first letter) under code point ``below``."""
    hit = [c for c in range(below) if unicodedata.category(chr(c))[0] == category]
    runs = [(c, next(d for d in range(c, below + 1) if d == below or unicodedata.category(chr(d))[0] != category) - 1)
            for c in hit if c == 0 or unicodedata.category(chr(c - 1))[0] != category]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


def latin_split():
    """``PATTERN`` for texts under U+0250, as a standard-library pattern: the same matches, in half the time."""
    letter, number, space = _ranges("L", 0x250), _ranges("N", 0x250), "\\t-\\r \\x85\\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+").findall


_BEYOND_LATIN = re.compile("[^\\x00-\\u024f]").search


class Codec:
    """Encoder and decoder for one rank vocabulary; holds a bounded cache of encoded pre-tokens."""

    def __init__(self, path: str = VOCAB, pattern: str = PATTERN, cache_size: int = CACHE_SIZE):
        self.tokens = read_ranks(path)
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self._sp = spm.SentencePieceProcessor(model_proto=model_proto(self.tokens))
        self._any_split = regex.compile(pattern).findall
        self._latin_split = latin_split() if pattern == PATTERN else None
        self._cache: dict[str, bytes] = {}
        self._cache_size = cache_size

    def _learn(self, pre: set[str]) -> None:
        if len(self._cache) + len(pre) > self._cache_size:
            self._cache.clear()
        new = list(pre)
        mapped = _SEP.join(x.encode().decode("latin-1") for x in new).translate(_STAND_IN).split(_SEP)
        for word, ids in zip(new, self._sp.encode(mapped, out_type=int, num_threads=1)):
            self._cache[word] = (np.array(ids, dtype="<u4") - np.uint32(1)).tobytes()

    def pre_tokens(self, text: str) -> list[str]:
        if self._latin_split is None or _BEYOND_LATIN(text):
            return self._any_split(text)
        return self._latin_split(text)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pre_tokens(t) for t in texts]
        known = self._cache
        words = set().union(*split)
        fresh = words.difference(known)
        if fresh:
            # when the cache is full it starts over with all words of the block
            self._learn(words if len(known) + len(fresh) > self._cache_size else fresh)
        get = known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        get = self.tokens.__getitem__
        return b"".join(map(get, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def codec(path: str = VOCAB, pattern: str = PATTERN) -> Codec:
    """One codec per worker and vocabulary."""
    key = (path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(path, pattern)
    return _CODECS[key]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB,
           pattern: str = PATTERN, keep_ids: bool = True) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids`` (array, with ``keep_ids``), ``ids_sha256`` and
    ``decoded_sha256`` (the round trip's bytes). No shuffle: each task encodes its own rows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = codec(vocab, pattern)
        for b in blocks(batches, "text"):
            ids = c.encode_many(texts_of(b))
            cols = {
                "id": b.column("id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids], pa.string()),
            }
            if keep_ids:
                ends = np.cumsum([0] + [len(x) // 4 for x in ids])
                flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
                cols["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_pydict(cols)

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", vocab: str = VOCAB) -> DataFrame:
    """Adds ``text``: the decoded ids (bytes that are no UTF-8 become U+FFFD; null ids give null)."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def to_text(ids):
        c = codec(vocab)
        return ids.map(lambda x: None if x is None else b"".join(c.tokens[i] for i in x).decode("utf-8", "replace"))

    return encoded.withColumn("text", to_text(ids_col))
