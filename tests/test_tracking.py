"""Streams that end when no job is pending."""

import os
import random

import pytest
from pyspark.sql import functions as F

from annomill.streaming.status import latest_status
from annomill.streaming.tracking import read_tracked, still_pending, track_status

SCHEMA = "batch_id string, status string, ts long, event_id long"


@pytest.fixture
def job(spark, tmp_path):
    """Adds files of events and starts the stream."""
    class Job:
        source, table, checkpoint = (str(tmp_path / name) for name in ("in", "table", "checkpoint"))

        def add(self, *events):
            spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

        def start(self, expected=None):
            events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.source)
            ids = expected and spark.createDataFrame([(i,) for i in expected], "batch_id string")
            return track_status(events, self.table, self.checkpoint, ids, interval="300 milliseconds")

        def twin(self):
            return latest_status(spark.read.schema(SCHEMA).parquet(self.source))

    return Job()


def goes_on(query):
    """All that has landed is done, and the stream still runs."""
    query.processAllAvailable()
    assert not query.awaitTermination(1)


def status_of(frame):
    return {r.batch_id: r.status for r in frame.collect()}


def test_ends_when_all_have_finished(spark, job, as_rows):
    job.add(("a", "validating", 1, 1), ("b", "in_progress", 2, 2))
    query = job.start(["a", "b"])
    goes_on(query)
    assert status_of(still_pending(spark, job.table)) == {"a": "validating", "b": "in_progress"}
    job.add(("a", "completed", 9, 4), ("a", "in_progress", 5, 5))
    goes_on(query)
    job.add(("b", "failed", 9, 6))
    assert query.awaitTermination(60) and query.exception() is None
    assert as_rows(read_tracked(spark, job.table), *SCHEMA.replace(" string", "").replace(" long", "").split(", ")) == as_rows(
        job.twin(), "batch_id", "status", "ts", "event_id")
    assert still_pending(spark, job.table).isEmpty()
    # A table that holds everything needs no more than two epochs.
    assert len([name for name in os.listdir(job.table) if name.startswith("epoch=")]) <= 2
    assert not spark.streams.active


def test_expected_batches_count_before_their_first_event(spark, job):
    job.add(("a", "completed", 1, 1))
    query = job.start(["a", "late"])
    goes_on(query)
    assert status_of(still_pending(spark, job.table)) == {"late": None}
    job.add(("late", "completed", 2, 2))
    assert query.awaitTermination(60)
    assert status_of(read_tracked(spark, job.table)) == {"a": "completed", "late": "completed"}


def test_restarts_go_on_from_the_state(spark, job, as_rows):
    rng, number = random.Random(1), 0
    for round_ in range(3):
        for _ in range(3):
            events = [(f"b{rng.randrange(6)}", rng.choice(["validating", "in_progress", "failed"]), rng.randrange(50), number + i)
                      for i in range(5)]
            number += 5
            job.add(*events)
        job.add(("open", "in_progress", round_, number))
        number += 1
        query = job.start()
        query.processAllAvailable()
        assert query.isActive
        query.stop()
        query.awaitTermination()
        assert as_rows(read_tracked(spark, job.table), "batch_id", "status", "ts", "event_id") == as_rows(
            job.twin(), "batch_id", "status", "ts", "event_id")
    job.add(*[(name, "completed", 99, 1000 + i) for i, name in enumerate(["open", *[f"b{n}" for n in range(6)]])])
    assert job.start().awaitTermination(60)
    assert as_rows(read_tracked(spark, job.table), "batch_id", "status", "ts", "event_id") == as_rows(
        job.twin(), "batch_id", "status", "ts", "event_id")
    # Nothing new and nothing pending: it ends by itself again.
    assert job.start().awaitTermination(60)


def test_a_finished_batch_may_open_again(spark, job):
    job.add(("a", "completed", 1, 1), ("b", "in_progress", 1, 2))
    query = job.start()
    goes_on(query)
    job.add(("a", "in_progress", 5, 3), ("b", "completed", 5, 4))
    goes_on(query)
    job.add(("a", "completed", 6, 5))
    assert query.awaitTermination(60)
    assert status_of(read_tracked(spark, job.table)) == {"a": "completed", "b": "completed"}


def test_a_failing_stream_leaves_no_listener_waiting(spark, job):
    job.add(("a", "completed", 1, 1))
    broken = spark.createDataFrame([("a",)], "batch_id string").select(
        F.when(F.col("batch_id") == "a", F.raise_error(F.lit("lost"))).otherwise("x").alias("batch_id"))
    events = spark.readStream.schema(SCHEMA).parquet(job.source)
    query = track_status(events, job.table, job.checkpoint, broken, interval="300 milliseconds")
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination(60)
    with pytest.raises(FileNotFoundError):
        read_tracked(spark, job.table)
