"""Structured Streaming jobs built from the batch expressions.

* T1/T2 stateless: every micro-batch goes through the batch operator inside ``foreachBatch``
  (payloads carry complete transcripts / messages, so no state is needed) and is appended.
* T3/T4 event-time state: session and sliding windows with a watermark; late rows beyond the
  watermark are dropped by Spark. Gaps between segments wait in a reorder buffer until the watermark
  passes them, so they do not depend on the order of arrival.
* T5 call assembly: segments are appended to a table; keyed state holds three numbers a call and an event-time
  timer that closes the call when it has been quiet for the timeout. Closed calls are read back from the table and scored
  by the skew-safe batch scorer (no segment is ever held in a state store).
* T6 a folder watch that feeds new files through the manifest filters.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pii import redact
from ..operators import rules
from ..sources import calls as call_src
from ..sources import files as file_src

# session_window merges events exactly `gap` apart; one microsecond less splits at >= 60 s,
# which is the reference's "gap >= 60 s" silence rule.
SILENCE_GAP = "59 seconds 999999 microseconds"


def write_epoch(df: DataFrame, base: str, epoch: int) -> None:
    """Idempotent micro-batch sink: each epoch overwrites its own ``epoch=<id>`` folder, so a batch
    that Spark replays after a failure replaces its earlier output instead of duplicating it."""
    df.write.mode("overwrite").parquet(os.path.join(base, f"epoch={epoch}"))


def payload_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).where(F.trim("value") != "").select(F.try_parse_json("value").alias("v"))


def score_stream(spark: SparkSession, folder: str, out_dir: str, checkpoint: str, lexicon=None, role: str = "operator",
                 trigger: dict | None = None):
    """Score payloads as they arrive; scores and rejects written per epoch as Parquet.

    Each payload carries a complete transcript (one request), so it is scored inside its row by the
    nested scorer: no shuffle per micro-batch."""
    from ..operators.nested import score_nested

    def per_batch(batch: DataFrame, epoch: int) -> None:
        calls, rejects = call_src.normalize_payloads(batch)
        wide = score_nested(calls, lexicon, role=role)
        write_epoch(rules.to_long(wide), os.path.join(out_dir, "scores"), epoch)
        write_epoch(rejects, os.path.join(out_dir, "rejects"), epoch)

    w = payload_stream(spark, folder).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def redact_stream(spark: SparkSession, folder: str, schema: str, text_col: str, out_dir: str, checkpoint: str,
                  trigger: dict | None = None):
    """Redact messages in flight (stateless projection, append)."""
    s = spark.readStream.schema(schema).parquet(folder)
    out = s.withColumn(text_col, redact(F.col(text_col)))
    return (out.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def silence_sessions(events: DataFrame, key: str, ts: str, gap: str = SILENCE_GAP, watermark: str = "1 day") -> DataFrame:
    """Activity sessions per key on event time; a new session starts after a silence >= 60 s."""
    return (events.withWatermark(ts, watermark)
            .groupBy(key, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")))


def silence_gaps(sessions: DataFrame, key: str, **seq_kw) -> DataFrame:
    """T3 follow-up on the sessions table (batch): the silence between consecutive sessions of a key,
    with the skew-safe ordered scan (a key with most of the sessions is split into ranges)."""
    from ..operators.sequence import ordered_context
    x = ordered_context(sessions.select(key, "first_ts", "last_ts"), key, ["first_ts"], lags=["last_ts"], **seq_kw)
    return x.select(key, F.col("prev_last_ts").alias("silence_from"), F.col("first_ts").alias("silence_to")).where(
        F.col("silence_from").isNotNull())


def health_windows(log: DataFrame, ts: str, latency: str, failed, window: str = "1 hour", slide: str | None = None,
                   watermark: str = "2 hours", k: int = 800) -> DataFrame:
    """T4: per window: requests, failure %, mean and approximate p95 latency (``w, n, fail_pct, mean, p95_approx``).

    The p95 comes from a mergeable quantile sketch (KLL of ``k``: rank error about 0.3 % at 800; exact up to k values).
    With ``slide``, rows are reduced once to panes of that length, and each sliding window merges its panes, so a row is
    not copied into every window that holds it. As a stream, sliding windows need append mode (two stateful steps).
    """
    rows = log.withWatermark(ts, watermark)
    pane = rows.groupBy(F.window(ts, slide or window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("bad"), F.sum(F.col(latency).cast("double")).alias("total"),
        F.count(latency).alias("known"), F.kll_sketch_agg_double(F.col(latency).cast("double"), k).alias("sketch"))
    if slide:
        pane = pane.groupBy(F.window(F.window_time("w"), window, slide).alias("w")).agg(
            F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("total").alias("total"), F.sum("known").alias("known"),
            F.kll_merge_agg_double("sketch").alias("sketch"))
    return pane.select("w", "n", (100.0 * F.col("bad") / F.col("n")).alias("fail_pct"),
                       F.when(F.col("known") > 0, F.col("total") / F.col("known")).alias("mean"),
                       F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.95).cast("double"))).alias("p95_approx"))


STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = "call_id string, first_ts timestamp, last_ts timestamp, n_segments long, complete boolean"


def store_segments(spark: SparkSession, segment_folder: str, schema, store: str, checkpoint: str, trigger: dict | None = None,
                   max_files_per_trigger: int | None = None):
    """T5, first query: arriving segments (``call_id, pos, speaker, text, start, end`` + event time ``ts``) go to
    ``store``, partitioned by event day, each with the time it ``arrived`` (of its file). Spark's file sink writes every
    segment once, also after a restart."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(segment_folder).withColumn("arrived", F.col("_metadata.file_modification_time"))
    return (s.withColumn("day", F.date_format("ts", "yyyyMMdd")).writeStream.format("parquet").partitionBy("day")
            .option("path", store).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())


def _spans_of_batches(batches):
    """(call_id, first, last, n) of each Arrow batch: a call with most of a micro-batch is a row a batch after it."""
    for pdf in batches:
        g = pdf.groupby("call_id", sort=False)["at"]
        yield g.agg(["min", "max", "size"]).reset_index().set_axis(["call_id", "first", "last", "n"], axis=1)


class _CallClock:
    """Three numbers a call (first and last event time, segments) and one timer; see ``closed_calls``."""

    def __init__(self, timeout_ms: int, keep_ms: int):
        self.timeout_ms, self.keep_ms = timeout_ms, keep_ms

    def init(self, handle):
        from pyspark.sql.types import LongType, StructType
        self.handle = handle
        self.span = handle.getValueState("span", StructType().add("first", LongType()).add("last", LongType()).add("n", LongType()).add("open", LongType()))

    def _wait(self, until: int) -> None:
        """One timer a call; one already behind the watermark (late segments) is due at once."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(until)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        known = self.span.exists()
        first, last, n, _ = self.span.get() if known else (None, None, 0, 1)
        for pdf in rows:
            lo, hi = int(pdf["first"].min()), int(pdf["last"].max())
            first, last, n = lo if first is None else min(first, lo), hi if last is None else max(last, hi), n + int(pdf["n"].sum())
        now = timerValues.getCurrentWatermarkInMs()
        # 2: open, but begun behind the watermark by more than the state is kept: earlier segments may be in the store
        flag = 1 if known or first + self.keep_ms > now else 2
        self.span.update((first, last, n, flag))
        self._wait(last + self.timeout_ms)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        first, last, n, flag = self.span.get()
        if not flag:  # closed, and kept long enough
            self.span.clear()
            yield pd.DataFrame()
            return
        self.span.update((first, last, n, 0))
        now = timerValues.getCurrentWatermarkInMs()
        self.handle.registerTimer(max(last + self.timeout_ms + self.keep_ms, now + 1))
        yield pd.DataFrame({"call_id": [key[0]], "first_ts": pd.to_datetime([first], unit="ms"), "last_ts": pd.to_datetime([last], unit="ms"),
                            "n_segments": [n], "complete": [flag == 1]})

    def close(self):
        pass


def closed_calls(segments: DataFrame, timeout_s: float = 300.0, keep_s: float = 86_400.0, skew_s: float = 300.0) -> DataFrame:
    """T5: calls (``call_id, first_ts, last_ts, n_segments``) as they fall quiet, from a stream with ``ts`` and ``arrived``.

    A call closes when the watermark passes its last segment by ``timeout_s``; its three numbers then stay for ``keep_s``, so
    a late segment reopens it and it closes again, later ones are evicted (``complete`` is false for a call reopened after
    that: its first segments lie before ``first_ts``). An event dated more than ``skew_s`` after its arrival counts
    as of then, so it moves neither the watermark nor its call's clock beyond the present.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class CallClock(_CallClock, StatefulProcessor):
        pass

    at = F.least("ts", F.col("arrived") + F.expr(f"INTERVAL {int(skew_s * 1e6)} MICROSECONDS"))
    # the watermark column stays behind: rows older than the watermark are not dropped, they reopen their call
    x = segments.withColumn("at_ts", at).withWatermark("at_ts", "0 seconds").select("call_id", F.unix_millis("at_ts").alias("at"))
    spans = x.mapInPandas(_spans_of_batches, "call_id string, first long, last long, n long")
    return spans.groupBy("call_id").transformWithStateInPandas(CallClock(int(timeout_s * 1000), int(keep_s * 1000)), CLOSED, "append", "eventTime")


def score_closed(spark: SparkSession, store: str, schema, out_dir: str, checkpoint: str, timeout_s: float = 300.0, keep_s: float = 86_400.0,
                 skew_s: float = 300.0, lexicon=None, role: str = "operator", trigger: dict | None = None,
                 max_files_per_trigger: int | None = None):
    """T5, second query: follows ``store`` and scores calls as they close, with all their segments in it.

    Calls are read back from the day partitions at or after their first segment. Scores go to one folder an epoch; a
    call that closes again is scored again, ``latest_scores`` takes its newest rows.
    """
    from ..session import cut_lineage
    from pyspark.sql.types import StructType

    full = StructType.fromJson(schema.jsonValue()).add("arrived", "timestamp").add("day", "string")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    r = spark.readStream.schema(full)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        closed = cut_lineage(batch)  # one row a call
        since = closed.agg(F.min("first_ts").alias("t"), F.bool_and("complete").alias("whole")).first()
        if since["t"] is None:
            return
        segs = spark.read.schema(full).parquet(store)
        if since["whole"]:
            segs = segs.where(F.col("day") >= since["t"].strftime("%Y%m%d"))
        segs = segs.join(closed.select("call_id"), "call_id", "left_semi").drop("ts", "day", "arrived")
        write_epoch(rules.to_long(rules.score_calls(segs, lexicon, role=role)), os.path.join(out_dir, "scores"), epoch)

    return (closed_calls(r.parquet(store), timeout_s, keep_s, skew_s).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def latest_scores(spark: SparkSession, out_dir: str) -> DataFrame:
    """The scores of ``score_closed``, of a call's newest epoch where it closed more than once."""
    rows = spark.read.parquet(os.path.join(out_dir, "scores"))
    cols = [c for c in rows.columns if c not in ("call_id", "metric", "epoch")]
    newest = rows.groupBy("call_id", "metric").agg(F.max_by(F.struct(*cols), "epoch").alias("r"))
    return newest.select("call_id", "metric", "r.*")


def manifest_stream(spark: SparkSession, folder: str, out_dir: str, checkpoint: str, trigger: dict | None = None):
    """Watch a folder for new files; accepted audio and rejects appended (contents not read)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    s = (spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(folder)
         .select("path", "modificationTime", "length"))

    def per_batch(batch: DataFrame, epoch: int) -> None:
        acc, rej = file_src.audio_manifest(batch)
        write_epoch(acc, os.path.join(out_dir, "accepted"), epoch)
        write_epoch(rej, os.path.join(out_dir, "rejected"), epoch)

    return (s.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


SILENCE_OUT = "call_id string, silence_from double, silence_to double, gap_s double"


class _Reorder:
    """Segments of a call behind the watermark, in time order; see ``silence_gaps_stream``."""

    def __init__(self, gap_s: float, idle_ms: int):
        self.gap_s, self.idle_ms = gap_s, idle_ms

    def init(self, handle):
        from pyspark.sql.types import DoubleType, LongType, StructType
        self.handle = handle
        row = StructType().add("ts", LongType()).add("start", DoubleType()).add("end", DoubleType()).add("pos", LongType())
        self.waiting = handle.getListState("waiting", row)
        self.last = handle.getValueState("last", StructType().add("end", DoubleType()).add("due", LongType()))

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        for pdf in rows:
            self.waiting.appendList([tuple(r) for r in zip(pdf["ms"].tolist(), pdf["start"].tolist(), pdf["end"].tolist(), pdf["pos"].tolist())])
            self.handle.registerTimer(max(int(pdf["ms"].max()), timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        now = timerValues.getCurrentWatermarkInMs()
        held = list(self.waiting.get()) if self.waiting.exists() else []
        ready = sorted((r for r in held if r[0] <= now), key=lambda r: (r[1], r[2], r[3]))
        prev = self.last.get()[0] if self.last.exists() else None
        out = []
        for _, start, end, _ in ready:
            if prev is not None and start - prev >= self.gap_s:
                out.append((key[0], prev, start, start - prev))
            prev = end
        if ready:
            due = max(r[0] for r in ready) + self.idle_ms
            self.last.update((prev, due))
            self.handle.registerTimer(max(due, now + 1))
            rest = [r for r in held if r[0] > now]
            if rest:
                self.waiting.put([tuple(r) for r in rest])
            else:
                self.waiting.clear()
        elif not held and self.last.exists() and now >= self.last.get()[1]:
            self.last.clear()  # idle
        yield pd.DataFrame(out, columns=["call_id", "silence_from", "silence_to", "gap_s"])

    def close(self):
        pass


def silence_gaps_stream(segments: DataFrame, gap_s: float = 60.0, watermark: str = "10 minutes",
                        idle_ms: int = 3_600_000) -> DataFrame:
    """T3 with segment end times: per call, the gap between a segment's start and the previous segment's end (in the order
    of start, end, position) is a silence when ``>= gap_s``.

    Segments may arrive in any order: they wait in a keyed buffer until the watermark (on ``ts``, the segment's start on the
    stream's clock) has passed them, and are then compared in time order. Segments later than the watermark are
    dropped by Spark. A call's last end stays for ``idle_ms`` of event time after it. The session needs the
    RocksDB state store (``STATE_PROVIDER``).
    """
    from pyspark.sql.streaming import StatefulProcessor

    class Reorder(_Reorder, StatefulProcessor):
        pass

    segments.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    x = segments.withWatermark("ts", watermark).select("call_id", "ts", F.unix_millis("ts").alias("ms"), F.col("start").cast("double").alias("start"),
                                                       F.col("end").cast("double").alias("end"), F.col("pos").cast("long").alias("pos"))
    return x.groupBy("call_id").transformWithStateInPandas(Reorder(gap_s, idle_ms), SILENCE_OUT, "append", "eventTime")
