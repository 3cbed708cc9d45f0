"""Streams equal their batch twins."""

import os
import tempfile

import duckdb
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01
from parley.functions.pii import redact
from parley.operators import rules, segments
from parley.sources import calls as call_src
from parley.sources.lexicon import TEST_LEXICON
from parley.sources.tables import read_table
from parley.streaming import jobs


def _tmp():
    return tempfile.mkdtemp(prefix="parley-stream-", dir="/tmp")


def test_score_stream_equals_batch(spark):
    conv = read_table(spark, SF001, "conversations")
    seg = segments.conversation_segments(conv)
    src = _tmp()
    # complete transcripts, one payload per call, spread over several files (several micro-batches)
    call_src.payloads_per_call(seg).repartition(3).write.mode("overwrite").text(os.path.join(src, "in"))
    out = _tmp()
    q = jobs.score_stream(spark, os.path.join(src, "in"), out, os.path.join(out, "_ck"), TEST_LEXICON, role="assistant",
                          trigger={"availableNow": True})
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "scores")).drop("epoch").collect())
    want = sorted(tuple(r) for r in rules.to_long(rules.score_calls(seg, TEST_LEXICON, role="assistant")).collect())
    assert got == want and len(got) == 5 * conv.select("conv_id").distinct().count()
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == 0


def test_redact_stream_equals_batch(spark):
    docs = read_table(spark, SF001, "documents", ["doc_id", "text"])
    src, out = _tmp(), _tmp()
    docs.write.mode("overwrite").parquet(os.path.join(src, "in"))
    q = jobs.redact_stream(spark, os.path.join(src, "in"), "doc_id long, text string", "text", os.path.join(out, "o"),
                           os.path.join(out, "_ck"))
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "o")).collect())
    want = sorted(tuple(r) for r in docs.select("doc_id", redact("text").alias("text")).collect())
    assert got == want


def test_silence_sessions_equal_lag(spark):
    ev = read_table(spark, SF01, "events", ["user_id", "ts"]).withColumn("ts", F.col("ts").cast("timestamp"))
    src = _tmp()
    ev.write.mode("overwrite").parquet(os.path.join(src, "in"))
    s = spark.readStream.schema("user_id long, ts timestamp").parquet(os.path.join(src, "in"))
    q = (jobs.silence_sessions(s, "user_id", "ts", watermark="40 days").writeStream.format("memory")
         .queryName("sessions_t3").outputMode("complete").start())
    q.processAllAvailable()
    n_sessions = spark.sql("select count(*) from sessions_t3").first()[0]
    sessions = spark.sql("select user_id, first_ts, last_ts from sessions_t3")
    n_plain = jobs.silence_gaps(sessions, "user_id", chunks=1).count()
    n_split = jobs.silence_gaps(sessions, "user_id", chunks=6).count()
    q.stop()
    con = duckdb.connect()
    n_gaps, n_users = con.execute(f"""
        WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p
                   FROM read_parquet('{SF01}/events.parquet'))
        SELECT count(*) FILTER (WHERE p IS NOT NULL AND epoch(ts) - epoch(p) >= 60), count(DISTINCT user_id) FROM e""").fetchall()[0]
    assert n_sessions == n_gaps + n_users
    assert n_plain == n_split == n_gaps   # every silence >= 60 s is a gap between two sessions


def test_health_windows_equal_batch(spark):
    ev = read_table(spark, SF01, "events", ["ts", "event_type", "value"]).withColumn("ts", F.col("ts").cast("timestamp"))
    src = _tmp()
    ev.write.mode("overwrite").parquet(os.path.join(src, "in"))
    s = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(os.path.join(src, "in"))
    q = (jobs.health_windows(s, "ts", "value", F.col("event_type") == "error").writeStream.format("memory")
         .queryName("health_t4").outputMode("complete").start())
    q.processAllAvailable()
    got = {(r.w.start, r.n, round(r.fail_pct, 6), round(r.mean, 6)) for r in spark.sql("select * from health_t4").collect()}
    q.stop()
    b = jobs.health_windows(ev, "ts", "value", F.col("event_type") == "error")
    want = {(r.w.start, r.n, round(r.fail_pct, 6), round(r.mean, 6)) for r in b.collect()}
    assert got == want and len(got) > 100


class Calls:
    """Segments of the smallest table's calls arriving in files, with the two queries of T5 over them."""

    def __init__(self, spark):
        self.spark, self.src, self.store, self.out = spark, _tmp(), _tmp(), _tmp()
        seg = segments.conversation_segments(read_table(spark, SF001, "conversations"))
        # event time: a fixed origin plus the segment end; calls are spread apart by conversation id
        self.seg = seg.withColumn("ts", F.timestamp_seconds(F.col("call_id").cast("long") * 100000 + F.col("end")))
        self.files = set()

    def arrive(self, rows, day="2030-01-01"):
        """One more file, dated later than the ones before."""
        import glob
        import time
        rows.coalesce(1).write.mode("append").parquet(os.path.join(self.src, "in"))
        new = set(glob.glob(os.path.join(self.src, "in", "*.parquet"))) - self.files
        self.files |= new
        at = time.mktime(time.strptime(day, "%Y-%m-%d")) + len(self.files)
        for path in new:
            os.utime(path, (at, at))

    def run(self):
        jobs.store_segments(self.spark, os.path.join(self.src, "in"), self.seg.schema, os.path.join(self.store, "s"), os.path.join(self.store, "_ck"),
                            max_files_per_trigger=1).awaitTermination(300)
        jobs.score_closed(self.spark, os.path.join(self.store, "s"), self.seg.schema, self.out, os.path.join(self.out, "_ck"), timeout_s=600,
                          lexicon=TEST_LEXICON, role="assistant").awaitTermination(300)

    def scores(self):
        return sorted(tuple(r) for r in jobs.latest_scores(self.spark, self.out).collect())

    def wanted(self, keep):
        cols = jobs.latest_scores(self.spark, self.out).columns
        long = rules.to_long(rules.score_calls(self.seg.drop("ts"), TEST_LEXICON, role="assistant"))
        return sorted(tuple(r) for r in long.where(keep).select(*cols).collect())


def test_late_segments_rescore_a_call_and_a_future_event_closes_nothing(spark):
    c = Calls(spark)
    cid = F.col("call_id").cast("long")
    late = (cid == 3) & (F.col("pos") >= 2)
    ahead = F.when((cid == 9) & (F.col("pos") == 0), F.timestamp_seconds(F.lit(4_000_000_000))).otherwise(F.col("ts"))
    # arrived on 11 January: call 9 (of the 11th) has an event dated a century ahead, call 3 comes in two parts
    c.arrive(c.seg.where((cid <= 9) & ~late).withColumn("ts", ahead), "1970-01-11")
    c.run()
    assert c.spark.read.schema("call_id string").parquet(os.path.join(c.store, "s")).where("call_id = 9").count() > 0
    c.arrive(c.seg.where(cid == 9).limit(1), "1970-01-11")
    c.run()
    closed = {int(r[0]) for r in c.scores()}
    assert 3 in closed and 9 not in closed
    before = [r for r in c.scores() if r[0] == "3"]
    c.arrive(c.seg.where(late), "1970-01-12")
    c.run()
    after = [r for r in c.scores() if r[0] == "3"]
    assert after == [r for r in c.wanted(cid == 3)] and len(before) == len(after) == 5


def test_restart_gives_equal_output(spark):
    cid = F.col("call_id").cast("long")
    files = [(0, 7), (7, 14), (14, 1000)]
    results = []
    for restart in (False, True):
        c = Calls(spark)
        for lo, hi in files:
            c.arrive(c.seg.where((cid >= lo) & (cid < hi)))
            if restart:
                c.run()
        c.run()
        results.append(c.scores())
    last = c.seg.agg(F.max(cid)).first()[0]
    want = c.wanted(cid < last)
    assert [{r[0] for r in x} ^ {r[0] for r in want} for x in results] == [set(), set()]
    assert results[0] == results[1] == want


def test_manifest_stream(spark):
    src, out = _tmp(), _tmp()
    for name, body in [("a.WAV", b"x"), ("b.mp3", b"yy"), ("c.txt", b"z"), ("d.flac", b"")]:
        with open(os.path.join(src, name), "wb") as f:
            f.write(body)
    q = jobs.manifest_stream(spark, src, out, os.path.join(out, "_ck"))
    q.awaitTermination(300)
    acc = sorted(os.path.basename(r.path) for r in spark.read.parquet(os.path.join(out, "accepted")).collect())
    rej = sorted((os.path.basename(r.path), r.reason) for r in spark.read.parquet(os.path.join(out, "rejected")).collect())
    assert acc == ["a.WAV", "b.mp3"]
    # Spark's file scan skips zero-length files, so the empty one is never accepted (nor listed)
    assert rej == [("c.txt", "unsupported file type")]


def test_silence_gaps_in_any_order_of_arrival(spark):
    conv = read_table(spark, SF001, "conversations")
    seg = segments.conversation_segments(conv)
    # event time = segment start on one shared clock (calls run concurrently); files hold turns out of order
    seg = seg.withColumn("ts", F.timestamp_seconds(F.col("start")))
    end = spark.createDataFrame([("end", 0, "x", "", 1e6, 1e6)], "call_id string, pos int, speaker string, text string, start double, end double")
    end = end.select(*(F.col(c).cast(seg.schema[c].dataType).alias(c) for c in seg.columns if c != "ts")).withColumn("ts", F.timestamp_seconds(F.col("start")))
    got = []
    for parts in ([(0, 100)], [(3, 100), (0, 1), (1, 3)]):
        src, out = _tmp(), _tmp()
        for lo, hi in parts:
            rows = seg.where((F.col("pos") >= lo) & (F.col("pos") < hi))
            rows.orderBy(F.xxhash64("pos", "call_id")).coalesce(1).write.mode("append").parquet(os.path.join(src, "in"))
        last = end.select(*seg.columns)
        last.coalesce(1).write.mode("append").parquet(os.path.join(src, "in"))
        s = spark.readStream.schema(seg.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "in"))
        q = (jobs.silence_gaps_stream(s, watermark="3 hours").writeStream.format("parquet").option("path", os.path.join(out, "o"))
             .option("checkpointLocation", os.path.join(out, "_ck")).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(600)
        got.append(sorted((r.call_id, round(r.silence_from, 3), round(r.silence_to, 3)) for r in spark.read.parquet(os.path.join(out, "o")).collect()))
    w = Window.partitionBy("call_id").orderBy("start", "end", "pos")
    want = seg.withColumn("pe", F.lag("end").over(w)).where(F.col("start") - F.col("pe") >= 60)
    want = sorted((r.call_id, round(r.pe, 3), round(r.start, 3)) for r in want.collect())
    assert got[0] == got[1] == want and len(want) > 5


def test_sliding_windows_as_a_stream_and_their_percentile(spark):
    """The stream equals the batch; p95 of the merged sketches lies within the stated rank error."""
    schema = "ts timestamp, event_type string, value double"
    ev = spark.range(40_000).select(F.timestamp_seconds(F.col("id") * 0.5).alias("ts"), F.lit("ok").alias("event_type"),
                                    (F.xxhash64("id") % 100_000).cast("double").alias("value"))
    src = _tmp()
    last = spark.createDataFrame([(400_000, "ok", 1.0)], "s long, event_type string, value double").select(
        F.timestamp_seconds("s").alias("ts"), "event_type", "value")
    ev.union(last).coalesce(1).write.mode("overwrite").parquet(os.path.join(src, "in"))
    s = spark.readStream.schema(schema).parquet(os.path.join(src, "in"))
    q = (jobs.health_windows(s, "ts", "value", F.col("event_type") == "error", "1 hour", "15 minutes").writeStream.format("memory")
         .queryName("health_sliding").outputMode("append").start())
    q.processAllAvailable()
    got = {r.w.start: (r.n, r.mean) for r in spark.sql("select * from health_sliding").collect()}
    q.stop()
    batch = jobs.health_windows(ev, "ts", "value", F.col("event_type") == "error", "1 hour", "15 minutes").collect()
    assert got == {r.w.start: (r.n, r.mean) for r in batch} and len(got) == 26
    plain = ev.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.floor(F.unix_seconds("ts") / 900) * 900 - 900 * i)).alias("s"), "value")
    rows = {}
    for r in plain.collect():
        rows.setdefault(r.s, []).append(r.value)
    for r in batch:
        values = rows[int(r.w.start.timestamp())]
        rank = sum(v <= r.p95_approx for v in values) / len(values)
        assert abs(rank - 0.95) < 0.01, (r.w.start, rank)


def test_health_windows_drop_late_rows(spark):
    """Append mode: a window is emitted once the watermark passes it; rows older than the watermark
    arriving later are dropped (complete mode would keep them)."""
    src, out = _tmp(), _tmp()
    base = "2024-01-01 00:"
    first = spark.createDataFrame([(f"{base}00:10", "ok", 1.0), (f"{base}10:00", "ok", 2.0), (f"{base}40:00", "error", 3.0),
                                   (f"{base}59:00", "ok", 1.0)], "ts string, event_type string, value double")
    advance = spark.createDataFrame([("2024-01-01 03:30:00", "ok", 5.0)], "ts string, event_type string, value double")
    late = spark.createDataFrame([("2024-01-01 00:20:00", "error", 9.0)], "ts string, event_type string, value double")
    cast = lambda d: d.withColumn("ts", F.to_timestamp("ts"))
    cast(first).write.mode("append").parquet(os.path.join(src, "in"))
    s = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1) \
        .parquet(os.path.join(src, "in"))
    q = (jobs.health_windows(s, "ts", "value", F.col("event_type") == "error", window="1 hour", watermark="1 hour")
         .writeStream.format("memory").queryName("health_late").outputMode("append").start())
    q.processAllAvailable()
    cast(advance).write.mode("append").parquet(os.path.join(src, "in"))
    q.processAllAvailable()          # watermark -> 02:30: the 00:00 window is emitted
    cast(late).write.mode("append").parquet(os.path.join(src, "in"))
    q.processAllAvailable()          # 00:20 is behind the watermark: dropped
    q.stop()
    rows = {r.w.start.hour: (r.n, round(r.fail_pct, 3)) for r in spark.sql("select * from health_late").collect()}
    assert rows[0] == (4, 25.0)   # the late 00:20 error row was dropped: 4 rows, 1 failure


def test_epoch_sink_is_idempotent(spark):
    out = _tmp()
    df = spark.range(10).withColumnRenamed("id", "x")
    jobs.write_epoch(df, os.path.join(out, "s"), 3)
    jobs.write_epoch(df, os.path.join(out, "s"), 3)      # a replayed micro-batch
    jobs.write_epoch(df.limit(4), os.path.join(out, "s"), 4)
    back = spark.read.parquet(os.path.join(out, "s"))
    assert back.count() == 14 and sorted(r.epoch for r in back.select("epoch").distinct().collect()) == [3, 4]
