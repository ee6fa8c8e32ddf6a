"""Streams over several micro-batches give the batch result."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.operators import aggregates, joins
from railgauge.plans import processing, warehouse
from railgauge.registry import views
from railgauge.sources import feeds
from railgauge.sources import sinks as table_sinks
from railgauge.sources import tables
from railgauge.streaming import headway, processing as stream_processing, sinks, windows

from compare import spark_rows


def land(df, folder, parts, order):
    """Write slices of the frame one after the other, so that each is a micro-batch."""
    for number, slice_id in enumerate(order):
        df.filter(F.col("_part") == slice_id).drop("_part").coalesce(1).write.parquet(f"{folder}/{number:03d}")
    assert len(order) == parts


def in_time_order(df, parts):
    bounds = df.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    span = (bounds.b - bounds.a).total_seconds() + 1
    share = (F.col("event_time").cast("double") - F.lit(bounds.a).cast("timestamp").cast("double")) / span
    return df.withColumn("_part", F.floor(share * parts))


def read(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def same(left, right):
    assert spark_rows(left.select(*sorted(left.columns))) == spark_rows(right.select(*sorted(right.columns)))


def in_files(df, parts):
    """Whole source files per part, so that times are out of order."""
    return df.withColumn("_part", F.pmod(F.hash("source_file"), F.lit(parts)).cast("bigint"))


def windows_of(spark, raw, schema, writer_of, tmp_path, parts=3):
    land(in_files(raw, parts), tmp_path / "in", parts, range(parts))
    writer = writer_of(str(tmp_path / "rows"), str(tmp_path / "windows"))
    sinks.drain(read(spark, tmp_path / "in", schema), writer, str(tmp_path / "checkpoint"), "append")
    return windows.read_windows(spark, str(tmp_path / "windows"))


def test_delay_windows(spark, sf_dir, tmp_path):
    raw = views.raw_delays(spark, sf_dir)
    streamed = windows_of(spark, views.twice(raw), schemas.RAW_DELAYS, windows.delay_windows, tmp_path)
    same(streamed, aggregates.delays_by_window(views.delays(spark, sf_dir)))


def test_late_rows_are_counted(spark, tmp_path):
    """A report hours late joins its window, and a replayed batch changes nothing."""
    start = datetime(2024, 1, 1)
    writer = windows.delay_windows(str(tmp_path / "rows"), str(tmp_path / "windows"))

    def batch(number, minutes):
        row = ("v", f"t{number}", "J", "A", 60, 60, f"f{number}", start + timedelta(minutes=minutes), number)
        return spark.createDataFrame([row], schemas.RAW_DELAYS)

    for number, minutes in enumerate([0, 3000, 3001, 1, 4500]):
        writer(batch(number, minutes), number)
    writer(batch(3, 1), 3)
    found = {r.window_start: r.delay_records for r in windows.read_windows(spark, str(tmp_path / "windows")).collect()}
    assert found == {start: 2, start + timedelta(minutes=3000): 2, start + timedelta(minutes=4500): 1}


def test_polling_trigger(spark, tmp_path):
    """A running query picks up files as they land."""

    def land_one(number):
        row = ("v", f"t{number}", "J", "A", 60, 60, f"f{number}", datetime(2024, 1, 1, 0, number), number)
        spark.createDataFrame([row], schemas.RAW_DELAYS).coalesce(1).write.parquet(str(tmp_path / f"in/{number}"))

    land_one(0)
    writer = windows.delay_windows(str(tmp_path / "rows"), str(tmp_path / "out"))
    stream = read(spark, tmp_path / "in", schemas.RAW_DELAYS)
    running = sinks.run_stream(stream, writer, str(tmp_path / "checkpoint"), "append", interval="1 second")
    try:
        running.processAllAvailable()
        land_one(1)
        running.processAllAvailable()
    finally:
        running.stop()
    assert [row.delay_records for row in windows.read_windows(spark, str(tmp_path / "out")).collect()] == [2]


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        feeds.stream_feed(spark, str(tmp_path / "nowhere"))


def test_headway_with_late_batches_and_replay(spark, sf_dir, tmp_path):
    """Batches in shuffled order, copies across batches, and one batch written twice."""
    raw = views.raw_positions(spark, sf_dir)
    shuffled = list(range(5))
    random.Random(7).shuffle(shuffled)
    parted = in_time_order(raw, 5).unionAll(raw.withColumn("_part", F.pmod(F.hash("feed_seq"), F.lit(5)).cast("bigint")))
    land(parted, tmp_path / "in", 5, shuffled)
    writer = headway.headway_tables(str(tmp_path / "landing"), str(tmp_path / "table"))
    stream = read(spark, tmp_path / "in", schemas.RAW_POSITIONS)
    sinks.drain(stream, writer, str(tmp_path / "checkpoint"), "append")
    expected = processing.clean_positions(raw)
    same(headway.read_headways(spark, str(tmp_path / "table")), expected)

    def landed():
        return spark.read.schema(f"{schemas.RAW_POSITIONS.rstrip()}, batch_id bigint").parquet(str(tmp_path / "landing"))

    again = landed().filter("batch_id = 2").drop("batch_id", "event_date").collect()
    writer(spark.createDataFrame(again, schemas.RAW_POSITIONS), 2)
    assert landed().count() == 2 * raw.count()
    same(headway.read_headways(spark, str(tmp_path / "table")), expected)


def test_headway_keeps_rows_without_time(spark, tmp_path):
    """Second zero (no time on the wire) and a null time both stay in the table."""
    t0 = datetime(2024, 1, 1)
    rows = [
        ("v1", "t", "J", "A", 1, 2, None, 0, "f", t0, 0),
        ("v2", "t", "J", "A", 1, 2, None, 5, "f", t0, 1),
        ("v3", "t", "J", "A", 1, 2, None, None, "f", t0, 2),
    ]
    raw = spark.createDataFrame(rows, schemas.RAW_POSITIONS)
    writer = headway.headway_tables(str(tmp_path / "landing"), str(tmp_path / "table"))
    writer(raw, 0)
    writer(raw.limit(0), 1)
    same(headway.read_headways(spark, str(tmp_path / "table")), processing.clean_positions(raw))


def test_named_stream_and_nested_source(spark, sf_dir, tmp_path):
    """Nested snapshots as a stream, flattened and joined to the static stops."""
    feed = views.feed(spark, sf_dir)
    feed.coalesce(1).write.parquet(str(tmp_path / "in/0"))
    raw = feeds.load_raw_delays(feeds.stream_feed(spark, f"{tmp_path}/in"), views.ROUTES)
    named = windows.named_delays_stream(raw, views.stops(spark, sf_dir))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / "out"))

    sinks.drain(named, write, str(tmp_path / "checkpoint"), "append")
    expected = joins.join_stops(feeds.load_raw_delays(feed, views.ROUTES), views.stops(spark, sf_dir))
    same(spark.read.parquet(str(tmp_path / "out")), expected)


def test_processing_new_files_equals_processing_everything(spark, sf_dir, tmp_path):
    """Snapshots landing in three rounds, streamed round by round, against one batch run."""
    feed, responses = views.feed(spark, sf_dir), views.weather_responses(spark, sf_dir)
    landing = stream_processing.Landing(*[f"{tmp_path}/feed"] * 3, f"{tmp_path}/weather")

    def part(df, number):
        return df.filter(F.pmod(F.hash("source_file"), F.lit(3)) == number)

    for number in (2, 0, 1):
        table_sinks.land_snapshots(part(feed, number), f"{tmp_path}/feed", str(number))
        table_sinks.land_snapshots(part(responses, number), f"{tmp_path}/weather", str(number))
        for stream in stream_processing.process_new(
            spark, landing, f"{tmp_path}/streamed", f"{tmp_path}/state", views.ROUTES, "parquet"
        ):
            stream.awaitTermination()

    snapshots = warehouse.Snapshots(feed, feed, feed, responses)
    warehouse.process(snapshots, f"{tmp_path}/batch", views.ROUTES)
    streamed = tables.open_catalog(spark, f"{tmp_path}/streamed")
    batch = tables.open_catalog(spark, f"{tmp_path}/batch")
    for name in tables.TABLES:
        same(streamed[name], batch[name])
