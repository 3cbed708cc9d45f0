"""Operator 1: URL filter over a sorted digest array.

A rule is a host followed by a path prefix, like ``example.net/en/``; it fits its host and all
subdomains where the URL's path starts with the rule's path. The longest fitting rule decides (of
equal lengths the one with the longer host).

* Index: rules are hashed (XXH64, seed 42) and dealt by digest to shards of bounded size.
* Keys of a URL: every host suffix joined to every path prefix whose length occurs among the rules.
  Only the distinct keys of all URLs are probed, so a host with a third of the rows costs one probe.
* Probe: each shard's sorted digests are memory-mapped from the task's own scratch file, all keys of
  a chunk are looked up by vectorised binary search, and the stored rule string is compared in full,
  so a digest collision never matches.
* The keys found are rules, so at most as many as there are rules; they join back to the distinct
  (host, path) pairs and those to the rows.

Defined results: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased, path what follows up to ``?``, ``#`` or the end; null URLs and URLs without ``://`` have
both empty and fit no rule; repeated rows get equal results; all columns of ``urls`` are kept
(``host``, ``path``, ``rule``, ``verdict`` replace columns of these names).
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import without

SHARD_RULES = 250_000
PART_KEYS = 250_000
SEED = 42
MAX_RULE_PATH = 2048


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def normalise_rules(rules: DataFrame) -> DataFrame:
    """(rule, path_len, verdict) from (rule, verdict): host lower-cased; repeated rules keep ``allow`` before
    ``block``. A rule without a host or with a path beyond ``MAX_RULE_PATH`` raises when it is read."""
    host = F.substring_index("rule", "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.expr("substr(rule, char_length(substring_index(rule, '/', 1)) + 1)")
    bad = (host == "") | (F.char_length(path) > MAX_RULE_PATH)
    path = F.when(bad, F.raise_error(F.concat(F.lit("bad URL rule: "), "rule"))).otherwise(path)
    flat = rules.where("rule is not null").select(F.concat(lower, path).alias("rule"), F.char_length(path).alias("path_len"), "verdict")
    return flat.groupBy("rule", "path_len").agg(F.min("verdict").alias("verdict"))


def sorted_array(digests: np.ndarray, scratch) -> np.ndarray:
    """The sorted digests as a read-only memory map of the open scratch file."""
    digests.astype("<u8").tofile(scratch)
    scratch.flush()
    return np.memmap(scratch, dtype="<u8", mode="r") if len(digests) else digests


def probe(keys: list[str], index: np.ndarray, stored: list[str]) -> np.ndarray:
    """Position of each key in the sorted index, or -1. ``stored`` is in index order."""
    want = np.fromiter((xxhash.xxh64_intdigest(k.encode(), SEED) for k in keys), dtype=np.uint64, count=len(keys))
    lo, hi = np.searchsorted(index, want, "left"), np.searchsorted(index, want, "right")
    out = np.full(len(keys), -1, dtype=np.int64)
    for i in np.flatnonzero(hi > lo).tolist():  # equal digests: confirm the stored string
        for j in range(int(lo[i]), int(hi[i])):
            if stored[j] == keys[i]:
                out[i] = j
                break
    return out


def lookup(keys: DataFrame, rules: DataFrame, n_rules: int) -> DataFrame:
    """The distinct ``key`` values that are rules: (rule, verdict), through the sharded digest array.

    Rules are dealt by digest to shards; the keys of a shard are dealt on to as many parts as they fill, each
    of which gets the shard's rules. No task holds more than about SHARD_RULES rules and PART_KEYS keys.
    """
    keys = cut_lineage(keys)
    shards = max(1, -(-n_rules // SHARD_RULES))
    parts = max(1, -(-keys.count() // (shards * PART_KEYS)))
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        stored = sorted((xxhash.xxh64_intdigest(r.encode(), SEED), r, v)
                        for r, v in zip(right.column("rule").to_pylist(), right.column("verdict").to_pylist()))
        wanted = left.column("key").to_pylist()
        with tempfile.TemporaryFile() as scratch:
            index = sorted_array(np.array([d for d, _, _ in stored], dtype=np.uint64), scratch)
            at = probe(wanted, index, [r for _, r, _ in stored])
            del index
        hit = [stored[j] for j in at[at >= 0].tolist()]
        return pa.table({"rule": pa.array([r for _, r, _ in hit], pa.string()), "verdict": pa.array([v for _, _, v in hit], pa.string())})

    left = keys.select("key", shard("key").alias("shard"), F.pmod(F.hash("key"), F.lit(parts)).alias("part"))
    right = rules.select("rule", "verdict", shard("rule").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(run, "rule string, verdict string")


def filter_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``. ``rules``: (rule, verdict)."""
    rules = cut_lineage(normalise_rules(rules))
    # number of rules and the lengths of their paths (distinct lengths: at most MAX_RULE_PATH + 1)
    size = rules.agg(F.count("*").alias("n"), F.collect_set("path_len").alias("lengths")).first()
    own = without(urls, ["host", "path", "rule", "verdict"])
    rows = urls.select(F.struct(*own).alias("_row"), host_of(urls[url_col]).alias("host"), path_of(urls[url_col]).alias("path"))
    places = rows.where("host <> ''").select("host", "path").distinct()
    suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split("host", "[.]"))),
                           lambda i: F.array_join(F.slice(F.split("host", "[.]"), i, 1 << 20), "."))
    lengths = F.array(*[F.lit(x) for x in sorted(size["lengths"])]).cast("array<int>")
    prefixes = F.transform(F.filter(lengths, lambda x: x <= F.char_length("path")), lambda x: F.substring(F.col("path"), F.lit(1), x))
    keyed = (places.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
             .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
             .where("suffix <> ''")
             .select("host", "path", F.concat("suffix", "prefix").alias("key"), F.char_length("suffix").alias("host_len")))
    found = cut_lineage(lookup(keyed.select("key").distinct(), rules, size["n"]))
    best = (keyed.join(found.withColumnRenamed("rule", "key"), "key")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.char_length("key").alias("n"), "host_len", F.col("key").alias("rule"), "verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))
    out = rows.join(cut_lineage(best), ["host", "path"], "left")
    return out.select(*(F.col("_row")[c].alias(c) for c in own), "host", "path", "rule",
                      F.coalesce("verdict", F.lit(default)).alias("verdict"))


def spam_hosts(urls: DataFrame, words: list[str], url_col: str = "url") -> DataFrame:
    """Block rules for the hosts of ``urls`` with a label that holds one of the words between hyphens.

    (rule, verdict): the host up to the spam label, e.g. ``casino-win.example.com`` without its ``www.``.
    """
    hosts = urls.select(host_of(F.col(url_col)).alias("host")).where("host <> ''").distinct()
    label = f"(?:^|[.])((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?(?:[.].*)?)$"
    rule = F.regexp_extract("host", label, 1)
    return hosts.select(rule.alias("rule")).where("rule <> ''").distinct().withColumn("verdict", F.lit("block"))
