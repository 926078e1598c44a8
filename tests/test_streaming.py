"""Streaming: bounded runs equal a batch read; restarts append only new files; tail skips old ones."""

from pyspark.sql import functions as F

from cadence.session import scratch_path
from cadence.sources import messages
from cadence.sources.schemas import EVENT_SCHEMA
from cadence.operators import clean
from cadence.sources.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from cadence.streaming import ingest, silver


def _events(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/events.parquet")


def test_ingest_twice_equals_batch_then_restart_appends(spark, sf_small):
    ev = _events(spark, sf_small)
    first = ev.where(F.col("ts") < "2024-01-15")
    later = ev.where(F.col("ts") >= "2024-01-15")
    src, out, ck = (scratch_path(spark, n) for n in ("src", "bronze", "ck"))
    messages.write_messages(messages.encode(first), src)
    ingest.ingest_bronze(spark, src, out, ck, EVENT_SCHEMA)
    ingest.ingest_bronze(spark, src, out, ck, EVENT_SCHEMA)
    bronze = spark.read.parquet(out)
    assert ingest.INGEST_DATE in bronze.columns
    bronze = bronze.drop(ingest.INGEST_DATE)
    assert bronze.count() == first.count()
    assert bronze.exceptAll(first).count() == 0
    messages.write_messages(messages.encode(later), src)
    ingest.ingest_bronze(spark, src, out, ck, EVENT_SCHEMA)
    got = spark.read.parquet(out).drop(ingest.INGEST_DATE)
    assert got.count() == ev.count()
    assert got.exceptAll(ev).count() == 0


def test_tail_skips_existing_messages(spark, sf_small):
    ev = _events(spark, sf_small)
    old = ev.where(F.col("ts") < "2024-01-10")
    new = ev.where(F.col("ts") >= "2024-01-10")
    src, out, ck = (scratch_path(spark, n) for n in ("tsrc", "tout", "tck"))
    messages.write_messages(messages.encode(old), src)
    run = ingest.tail(spark, src, out, ck, EVENT_SCHEMA)
    messages.write_messages(messages.encode(new), src)
    run()
    got = spark.read.parquet(out)
    assert got.count() == new.count() and got.exceptAll(new).count() == 0


def test_trend_drops_messages_behind_the_watermark(spark):
    from pyspark.sql import functions as F

    from cadence.session import scratch_path
    from cadence.sources import messages
    from cadence.sources.schemas import EVENT_SCHEMA
    from cadence.streaming import ingest

    src, out, ck = (scratch_path(spark, n) for n in ("late-src", "late-out", "late-ckpt"))

    def send(*hours):
        rows = spark.createDataFrame([(f"2024-05-01 {h}:10:00",) for h in hours], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
        messages.write_messages(messages.encode(rows), src)
        ingest.hourly_trend(spark, src, out, ck, EVENT_SCHEMA, watermark="1 hour")

    send("01", "01", "02")
    send("09")
    send("01", "09", "08")  # 01 is far behind the watermark, 08 is not
    got = {r.hour.hour: r.message_count for r in ingest.read_trend(spark, out).collect()}
    assert got == {1: 2, 2: 1, 8: 1, 9: 2}


# ---------------------------------------------------------------- bounded continuous runs

def test_bounded_run_takes_files_that_arrive_while_it_runs(spark, sf_small):
    import threading
    ev = _events(spark, sf_small)
    src, out, ck = (scratch_path(spark, n) for n in ("bsrc", "bbronze", "bck"))
    messages.write_messages(messages.encode(ev.where("event_id % 3 = 0")), src)
    late = threading.Timer(1.5, lambda: messages.write_messages(messages.encode(ev.where("event_id % 3 = 1")), src))
    late.start()
    log = ingest.ingest_bounded(spark, src, out, ck, EVENT_SCHEMA, seconds=6, every="500 milliseconds")
    late.join()
    bronze = spark.read.parquet(out).drop(ingest.INGEST_DATE)
    assert sum(n for _, n in log) == bronze.count() == ev.where("event_id % 3 < 2").count()
    assert len(log) >= 2 and [b for b, _ in log] == sorted({b for b, _ in log})
    assert not [q for q in spark.streams.active if q.isActive]  # stopped
    messages.write_messages(messages.encode(ev.where("event_id % 3 = 2")), src)
    log = ingest.ingest_bounded(spark, src, out, ck, EVENT_SCHEMA, seconds=0.1, every="1 second")  # a restart drains what is new
    assert sum(n for _, n in log) == ev.where("event_id % 3 = 2").count()
    got = spark.read.parquet(out).drop(ingest.INGEST_DATE)
    assert got.count() == ev.count() and got.exceptAll(ev).count() == 0


def test_bounded_run_raises_what_the_stream_raised(spark):
    import pytest
    src, out, ck = (scratch_path(spark, n) for n in ("fsrc", "fbronze", "fck"))
    messages.write_messages(spark.createDataFrame([("{}",)], "value string"), src)
    spark.range(1).write.parquet(f"{out}/not-a-partition-folder")
    with pytest.raises(Exception):  # noqa: B017
        ingest.ingest_bounded(spark, src, out, ck, EVENT_SCHEMA, seconds=5, every="500 milliseconds", sink_format="no_such_format")


# ---------------------------------------------------------------- Bronze to Silver

def _track(spark, rows):
    """(track_id, minute, genre, popularity) as messages; None for a minute gives unreadable time."""
    base = {c: "x" if MESSAGE_SCHEMA[c].dataType.simpleString() == "string" else 1 for c in MESSAGE_COLUMNS}
    made = []
    for key, minute, genre, popularity in rows:
        time = f"2024-05-{1 + minute // 1440:02d}T{minute // 60 % 24:02d}:{minute % 60:02d}:00.000000" if minute is not None else "not a time"
        r = base | {"track_id": key, "kafka_timestamp": time, "track_genre": genre, "popularity": popularity, "explicit": "True"}
        made.append(tuple(float(r[c]) if MESSAGE_SCHEMA[c].dataType.simpleString() == "float" else r[c] for c in MESSAGE_COLUMNS))
    return spark.createDataFrame(made, MESSAGE_SCHEMA)


def test_silver_stream_equals_batch_silver_within_its_watermark(spark):
    src, out, ck = (scratch_path(spark, n) for n in ("ssrc", "sout", "sck"))
    run = lambda: silver.stream_silver(spark, src, out, ck, MESSAGE_SCHEMA, delay="60 minutes", gap="30 minutes")
    batches = [
        [("a", 100, "rock", 50), ("b", 100, "pop", 50), ("n", 101, None, 50), ("bad", None, "pop", 50)],
        [("a", 90, "rock", 40), ("a", 90, "folk", 30), ("b", 100, "pop", 50), ("c", 110, "pop", 101), ("d", 110, "pop", 7)],  # earlier and tied rows arrive later
        [("z", 500, "pop", 1)],                                        # moves the watermark to 440: a, b, c and d are settled
        [("a", 105, "aaa", 1), ("e", 300, "pop", 9), ("f", 470, "pop", 9), ("d", 480, "pop", 8)],  # two too late, one in time, d again beyond its gap
        [("beat", 10_000, None, 1)],                                   # a row that is dropped still moves the watermark
    ]
    for batch in batches:  # each run is a restart from the checkpoint
        _track(spark, batch).coalesce(1).write.mode("append").parquet(src)
        run()
    got = spark.read.parquet(out)
    in_time = [r for b in (0, 1, 2) for r in batches[b]] + [batches[3][2]]
    want = clean.silver(_track(spark, [r for r in in_time if r[1] is not None]))
    once = got.where("not (track_id = 'd' and popularity = 8)")
    assert once.count() == want.count() and once.exceptAll(want.select(*once.columns)).count() == 0
    assert {(r.track_id, r.track_genre, r.popularity, r.explicit) for r in got.collect()} == {
        ("a", "folk", 30, 1), ("b", "pop", 50, 1), ("d", "pop", 7, 1), ("d", "pop", 8, 1), ("z", "pop", 1, 1), ("f", "pop", 9, 1)}
    run()  # nothing new, nothing twice
    assert spark.read.parquet(out).count() == 6


def test_silver_stream_that_writes_at_once(spark):
    src, out, ck = (scratch_path(spark, n) for n in ("fssrc", "fsout", "fsck"))
    run = lambda: silver.stream_silver(spark, src, out, ck, MESSAGE_SCHEMA, keep="first", delay="60 minutes")
    for batch in ([("a", 100, "rock", 50)], [("a", 90, "rock", 40), ("b", 95, "pop", 5)], [("z", 500, "pop", 1)], [("b", 100, "pop", 6), ("a", 470, "pop", 2)]):
        _track(spark, batch).coalesce(1).write.mode("append").parquet(src)
        run()
    got = sorted((r.track_id, r.popularity) for r in spark.read.parquet(out).collect())
    # a's second row is a duplicate, b's second is later than the watermark, a's third comes after its state expired
    assert got == [("a", 2), ("a", 50), ("b", 5), ("z", 1)]


def test_silver_stream_deals_its_state_by_the_size_of_the_input(spark, sf_small, monkeypatch):
    """Dealt to the session's few partitions, the rows of a large input spill in their sort and their state fills the heap."""
    from pathlib import Path

    from cadence.plans import binding, q_stream

    seen, run = [], silver.stream_silver
    monkeypatch.setattr(silver, "stream_silver", lambda *a, **kw: (seen.append(a[3]), run(*a, **kw))[1])
    monkeypatch.setattr(binding, "PARTITION_BYTES", 2048)
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions")}
    n = binding.partitions(spark, sf_small)
    got = q_stream.stream_silver(spark, sf_small)
    want = clean.silver(binding.tracks(spark, sf_small))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    state = Path(seen[0].removeprefix("file:")) / "state" / "0"
    assert n > 8 and len([p for p in state.iterdir() if p.name.isdigit()]) == n
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.delta"))  # RocksDB's files, not maps of the heap
    assert {c: spark.conf.get(c, None) for c in before} == before  # the session is left as it was
