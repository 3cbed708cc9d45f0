"""Operator 13: lines that many documents share, found by two Bloom filters.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that stand in at least ``min_docs`` documents lose their lines.

1. Every task hashes the distinct keys of its documents and sends the hashes, packed by page of the filters, to
   the tasks that hold the pages. A page is a pair of Bloom filters: a hash enters the second one (seen twice) if
   another task, or another document of the same task, has brought it or a hash with the same bits before.
   No key seen twice is missed; some seen once are suspected.
2. The second filter goes to all tasks (``FILTER_BITS`` at most, 8 bits a line up to there). Only keys it
   suspects leave the map side, counted there first: a count of the keys themselves confirms or clears each one.
   A filter too small for the table clears fewer keys before the shuffle, results stay the same.
3. Confirmed keys of up to ``BROADCAST_BYTES`` go to the tasks, which drop the lines in one map pass. More of them are
   joined with the suspected lines by key, and the line numbers with the documents by id and text digest.

``keep="none"`` drops every line of a confirmed key, ``keep="first"`` leaves the first one: of the smallest id (null
before all others), then the smallest SHA-256 of the text, then the smallest line number.

Defined results: a null text is the empty text, one empty line; a document is a row, so repeated rows
count as often as they stand there, and with ``keep="first"`` rows of the same id and text keep the same lines; a text of any
length is read whole; the text is replaced by what is left, further columns stay, and the added ones
(``n_lines``, ``n_dropped``) replace those of the same names. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage, shuffle_partitions
from .common import blocks, free_name, texts_of, without

#: bits of one page of a filter, and hash functions
PAGE_BITS = 1 << 17
PROBES = 4
#: largest filter that is sent to the tasks (128 MB)
FILTER_BITS = 1 << 30
#: confirmed keys that are sent to the tasks
BROADCAST_BYTES = 16_000_000
#: hashes a task gathers before it passes them on
FLUSH = 2_000_000


def line_keys(text: str) -> list[bytes]:
    """Keys of all lines of a text, in order."""
    return [line.strip() for line in text.encode().lower().split(b"\n")]


def _long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _positions(hashes: np.ndarray) -> np.ndarray:
    """Bits of each hash within its page, from the 40 lower bits of the hash."""
    first, step = hashes & np.uint64(PAGE_BITS - 1), (hashes >> np.uint64(20)) | np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(PAGE_BITS - 1)).astype(np.int64)


def _pages(hashes: np.ndarray, pages: int) -> np.ndarray:
    """Page of each hash, from its 32 upper bits; keeps their order."""
    return ((hashes >> np.uint64(32)) * np.uint64(pages) >> np.uint64(32)).astype(np.int64)


def _hashes_of(texts: list[str], min_chars: int) -> np.ndarray:
    """One hash for each distinct key of each text."""
    digest = xxhash.xxh64_intdigest
    out: list[int] = []
    for t in texts:
        out += [digest(k) for k in set(line_keys(t)) if _long(k, min_chars)]
    return np.array(out, dtype=np.uint64)


def _packed(hashes: np.ndarray, pages: int) -> pa.RecordBatch:
    """Rows (page, hashes seen once, hashes seen more often)."""
    values, counts = np.unique(hashes, return_counts=True)
    page = _pages(values, pages)
    cuts = np.flatnonzero(np.diff(page, prepend=-1, append=pages))
    rows = [(page[a], values[a:b][counts[a:b] == 1].tobytes(), values[a:b][counts[a:b] > 1].tobytes()) for a, b in zip(cuts, cuts[1:])]
    p, once, twice = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                                      names=["page", "once", "twice"])


def _filled(batches):
    """(page, bits) of the second filter from rows sorted by page."""
    page, once, twice = None, None, None
    for b in batches:
        for p, one, two in zip(*(c.to_pylist() for c in b.columns)):
            if p != page:
                if page is not None and twice.any():
                    yield page, twice
                page, once, twice = p, np.zeros(PAGE_BITS, dtype=bool), np.zeros(PAGE_BITS, dtype=bool)
            for brought, again in ((one, False), (two, True)):
                bits = _positions(np.frombuffer(brought, dtype=np.uint64))
                twice[bits if again else bits[once[bits].all(axis=1)]] = True
                once[bits] = True
    if page is not None and twice.any():
        yield page, twice


def twice_filter(docs: DataFrame, min_chars: int, pages: int) -> np.ndarray:
    """The filter of keys seen in two documents or more: a row of ``PAGE_BITS`` / 8 bytes for each page.
    ``docs`` has the texts as ``text``."""

    def hashes(batches):
        pending, n = [], 0
        for b in blocks(batches):
            pending.append(_hashes_of(texts_of(b), min_chars))
            n += len(pending[-1])
            if n > FLUSH:
                yield _packed(np.concatenate(pending), pages)
                pending, n = [], 0
        if n:
            yield _packed(np.concatenate(pending), pages)

    def fill(batches):
        for page, bits in _filled(batches):
            yield pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    sent = docs.select("text").mapInArrow(hashes, "page bigint, once binary, twice binary")
    parts = min(pages, shuffle_partitions(docs.sparkSession))
    held = sent.repartition(parts, "page").sortWithinPartitions("page").mapInArrow(fill, "page bigint, bits binary")
    out = np.zeros((pages, PAGE_BITS // 8), dtype=np.uint8)
    for page, bits in held.collect():  # FILTER_BITS / 8 bytes at most
        out[page] = np.frombuffer(bits, dtype=np.uint8)
    return out


def _suspected(keys: list[bytes], held: np.ndarray) -> list[bytes]:
    hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
    bits, page = _positions(hashes), _pages(hashes, len(held))
    hit = (held[page[:, None], bits >> 3] >> (bits & 7).astype(np.uint8)) & 1
    return [keys[i] for i in np.flatnonzero(hit.all(axis=1)).tolist()]


def _occurrences(docs: DataFrame, held, min_chars: int, places: str) -> DataFrame:
    """Suspected keys: one row for each document and key (``places`` "none"), with id, text digest and first line
    number ("first"), or one for each line ("all")."""
    id_type = docs.schema["id"].dataType

    def run(batches):
        for b in blocks(batches):
            rows, lines, found, digests = [], [], [], []
            per_text = [line_keys(t) for t in texts_of(b)]
            known = set().union(*per_text)
            known = set(_suspected([k for k in known if _long(k, min_chars)], held.value))
            for row, keys in enumerate(per_text):
                if places == "all":
                    here = [(k, i) for i, k in enumerate(keys) if k in known]
                else:
                    here = list({k: i for i, k in reversed(list(enumerate(keys))) if k in known}.items())
                found += [k for k, _ in here]
                if places != "none":
                    lines += [i for _, i in here]
                    rows += [row] * len(here)
                    digests += [hashlib.sha256(texts_of(b.slice(row, 1))[0].encode()).hexdigest()] * len(here) if here else []
            out = {"key": pa.array([k.decode() for k in found], pa.string())}
            if places != "none":
                out |= {"id": b.column("id").take(pa.array(rows, pa.int64())), "digest": pa.array(digests, pa.string()), "line": pa.array(lines, pa.int64())}
            yield pa.RecordBatch.from_pydict(out)

    schema = StructType.fromDDL("key string") if places == "none" else StructType.fromDDL("key string").add(
        "id", id_type).add("digest", "string").add("line", "long")
    return docs.select("id", "text").mapInArrow(run, schema)


def _kept(batches, source: str, gone_of):
    """Batches with the texts that are left; ``gone_of`` gives, for a slice, the dropped line numbers of each row."""
    for b in blocks(batches, source):
        n_lines, n_dropped, left = [], [], []
        texts = texts_of(b, source)
        for text, gone in zip(texts, gone_of(b, texts)):
            lines = text.split("\n")
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            left.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
        yield b, pa.array(left, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())


def repeated_keys(docs: DataFrame, held, min_docs: int, min_chars: int, keep: str) -> DataFrame:
    """Confirmed keys (``key``; with ``keep="first"`` also ``id, digest, line`` of the first place)."""
    found = _occurrences(docs, held, min_chars, keep)
    if keep == "none":
        return found.groupBy("key").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("key")
    first = F.min(F.struct("id", "digest", "line")).alias("first")
    return found.groupBy("key").agg(F.count("*").alias("docs"), first).where(F.col("docs") >= min_docs).select("key", "first.*")


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", id_col: str = "doc_id",
                      text_col: str = "text", filter_bits: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the lines of keys that stand in ``min_docs`` (2 or more) documents, and ``n_lines, n_dropped``."""
    if keep not in ("none", "first") or min_docs < 2 or min_chars < 0:
        raise ValueError("keep is 'none' or 'first', min_docs 2 or more, min_chars 0 or more")
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    if filter_bits is None:
        lines = plain.agg(F.sum(F.size(F.split("text", "\n")).cast("bigint"))).first()[0] or 0
        filter_bits = min(8 * lines, FILTER_BITS)
    held = spark.sparkContext.broadcast(twice_filter(plain, min_chars, max(1, -(-filter_bits // PAGE_BITS))))
    keys = cut_lineage(repeated_keys(plain, held, min_docs, min_chars, keep))
    size = keys.agg(F.sum(F.octet_length("key") + F.lit(64))).first()[0] or 0

    names = ["n_lines", "n_dropped"]
    keep_cols = without(docs, names)
    source, ident, gone = (free_name([*keep_cols, *names], n) for n in ("text", "id", "gone"))
    schema = StructType([*(docs.schema[c] if c != text_col else StructType().add(c, "string")[0] for c in keep_cols)]).add(
        "n_lines", "long").add("n_dropped", "long")
    src = docs.select(*(F.lit(None).cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in keep_cols),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(source), F.col(f"`{id_col}`").alias(ident))
    at = keep_cols.index(text_col)

    def rebuilt(batch, left, n_lines, n_dropped):
        cols = [left if i == at else batch.column(i) for i in range(len(keep_cols))]
        return pa.RecordBatch.from_arrays([*cols, n_lines, n_dropped], names=[*keep_cols, *names])

    if size <= broadcast_bytes:  # bounded by that parameter
        rows = keys.collect()
        sent = spark.sparkContext.broadcast({r["key"].encode(): None if keep == "none" else (r["id"], r["digest"], r["line"]) for r in rows})

        def gone_of(batch, texts):
            ids = batch.column(ident).to_pylist() if keep == "first" else None
            for row, text in enumerate(texts):
                hit = {i: k for i, k in enumerate(line_keys(text)) if k in sent.value}
                if hit and ids is not None:
                    me = (ids[row], hashlib.sha256(text.encode()).hexdigest())
                    hit = {i: k for i, k in hit.items() if (*me, i) != sent.value[k]}
                yield hit

        def drop(batches):
            for b, *new in _kept(batches, source, gone_of):
                yield rebuilt(b, *new)

        return src.mapInArrow(drop, schema)

    places = _occurrences(plain, held, min_chars, "all")
    if keep == "first":
        firsts = keys.select("key", F.struct("id", "digest", "line").alias("_first"))
        places = places.join(firsts, "key").where(~F.struct("id", "digest", "line").eqNullSafe(F.col("_first")))
    else:
        places = places.join(keys, "key", "left_semi")
    lines = places.groupBy("id", "digest").agg(F.collect_set("line").alias("gone"))
    lines = cut_lineage(lines.withColumnsRenamed({"id": "_i", "digest": "_d", "gone": gone}))
    src = src.withColumn("_digest", F.sha2(F.col(source).cast("binary"), 256))
    src = src.join(lines, src[ident].eqNullSafe(lines["_i"]) & (src["_digest"] == lines["_d"]), "left").select(
        *(src[c] for c in keep_cols), src[source], src[ident], lines[gone])

    def drop_listed(batches):
        for b, *new in _kept(batches, source, lambda b, _: (set(g or ()) for g in b.column(gone).to_pylist())):
            yield rebuilt(b, *new)

    return src.mapInArrow(drop_listed, schema)
