import json
import os

import pytest
from pyspark.sql import functions as F

from annomill.operators.annotate import annotate_long
from annomill.operators.reshape import nest_wide, pivot_wide
from annomill.operators.usage import batch_usage
from annomill.sinks import staged as staging
from annomill.sinks.annotations import write_annotations
from annomill.sinks.staged import settle, staged
from annomill.sources.outputs import read_outputs
from annomill.streaming.outputs import landing_outputs, read_annotations, stream_outputs
from annomill.streaming.status import compact_status, latest_status, pending, read_status, stream_status
from annomill.streaming.summaries import compact_usage, read_usage, stream_usage

LONG = [("a", "X", 1.0, "stop", 'said "1",\n then'), ("b", "X", float("nan"), "length", " cut"), ("a", "Y", 5.0, "stop", "5")]
SCHEMA = "custom_id string, demand string, level double, finish_reason string, model_response string"


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(LONG, SCHEMA)


def test_formats(spark, tmp_path, long, as_rows):
    write_annotations(long, str(tmp_path / "j"), "jsonl")
    write_annotations(long, str(tmp_path / "c"), "csv")
    write_annotations(long, str(tmp_path / "p"), "parquet")
    def shown(frame):
        return as_rows(frame.withColumn("level", F.col("level").cast("string")))

    expected = shown(long)
    assert ("b", "X", "NaN", "length", " cut") in expected
    assert shown(spark.read.schema(SCHEMA).json(str(tmp_path / "j"))) == expected
    options = {"header": True, "multiLine": True, "escape": '"'}
    assert shown(spark.read.schema(SCHEMA).options(**options).csv(str(tmp_path / "c"))) == expected
    assert shown(spark.read.parquet(str(tmp_path / "p"))) == expected
    # A second write replaces the first.
    write_annotations(long.limit(1), str(tmp_path / "j"), "jsonl")
    assert spark.read.schema(SCHEMA).json(str(tmp_path / "j")).count() == 1


@pytest.mark.parametrize("format", ["jsonl", "csv", "parquet"])
def test_split_by_demand(spark, tmp_path, long, format):
    write_annotations(long, str(tmp_path), format, split_by_demand=True)
    assert {path.name for path in tmp_path.glob("demand=*")} == {"demand=X", "demand=Y"}


@pytest.mark.parametrize("format", ["jsonl", "csv", "parquet"])
@pytest.mark.parametrize("split", [False, True])
def test_failed_writes_leave_the_earlier_result(spark, tmp_path, long, as_rows, format, split):
    path = str(tmp_path / "out")
    write_annotations(long, path, format, split)
    names = sorted(f for _, _, files in os.walk(path) for f in files)
    with pytest.raises(ValueError, match="no annotations"):
        write_annotations(long.where("demand = 'Z'"), path, format, split)
    failing = long.repartition(3).withColumn("custom_id", F.when(F.col("custom_id") == "b", F.raise_error(F.lit("lost")))
                                             .otherwise(F.col("custom_id")))
    with pytest.raises(Exception, match="lost"):
        write_annotations(failing, path, format, split)
    with pytest.raises(ValueError, match="no annotations"):
        write_annotations(long.limit(0), str(tmp_path / "new"), format, split)
    assert sorted(f for _, _, files in os.walk(path) for f in files) == names
    assert os.listdir(tmp_path) == ["out"]


def test_a_result_may_replace_what_it_was_read_from(spark, tmp_path, long, as_rows):
    path = str(tmp_path / "out")
    write_annotations(long, path, "parquet")
    write_annotations(spark.read.parquet(path).where("demand = 'X'"), path, "parquet")
    spark.catalog.refreshByPath(path)
    assert as_rows(spark.read.parquet(path), "custom_id", "demand") == [("a", "X"), ("b", "X")]


def test_a_write_that_ended_between_its_renames(spark, tmp_path):
    path, aside = tmp_path / "out", tmp_path / ".out.before-1"
    aside.mkdir()
    (aside / "x").write_text("earlier")
    settle(spark, str(path))
    assert (path / "x").read_text() == "earlier" and os.listdir(tmp_path) == ["out"]
    # With a target, what stepped aside is of no use any more.
    aside.mkdir()
    settle(spark, str(path))
    assert os.listdir(tmp_path) == ["out"]
    with pytest.raises(OSError, match="nothing was written"):
        with staged(spark, str(path)):
            pass
    with pytest.raises(RuntimeError):
        with staged(spark, str(path)) as place:
            os.makedirs(place.removeprefix("file:"))
            raise RuntimeError
    assert (path / "x").read_text() == "earlier" and os.listdir(tmp_path) == ["out"]


def test_a_rename_that_fails_puts_the_earlier_result_back(spark, tmp_path, monkeypatch):
    path = tmp_path / "out"
    path.mkdir()
    (path / "x").write_text("earlier")
    rename = staging._Folder.rename
    monkeypatch.setattr(staging._Folder, "rename", lambda self, source, target: rename(
        self, staging._Folder.beside(self, "gone", "0") if ".staged-" in source.toString() else source, target))
    with pytest.raises(Exception):
        with staged(spark, str(path)) as place:
            os.makedirs(place.removeprefix("file:"))
    assert (path / "x").read_text() == "earlier"


def test_what_cannot_be_written(tmp_path, long):
    wide = pivot_wide(long.withColumn("o", F.lit(1)), F.col("o"), ["X", "Y"])
    nested = nest_wide(long.withColumn("o", F.lit(1)), F.col("o"), ["X", "Y"])
    with pytest.raises(ValueError, match="long form"):
        write_annotations(wide, str(tmp_path / "x"), split_by_demand=True)
    with pytest.raises(ValueError, match="long form"):
        write_annotations(nested, str(tmp_path / "x"), split_by_demand=True)
    with pytest.raises(ValueError, match="CSV"):
        write_annotations(nested, str(tmp_path / "x"), "csv")
    with pytest.raises(ValueError, match="no annotations"):
        write_annotations(long.limit(0), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="format"):
        write_annotations(long, str(tmp_path / "x"), "xml")


def land(base, part, ids, name="output.jsonl", model="gpt-4o"):
    folder = base / part
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w") as f:
        for i in ids:
            body = {"model": f"{model}-{i}", "choices": [{"finish_reason": "stop", "message": {"content": f"x\n\nis {i % 7}"}}],
                    "usage": {"prompt_tokens": i, "completion_tokens": i * i % 50}}
            f.write(json.dumps({"custom_id": str(i), "response": {"body": body}}) + "\n")


def test_outputs_are_taken_in_once(spark, tmp_path, as_rows):
    base, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    land(base, "AA_part1", range(10))
    (base / "AA_part1" / "input.jsonl").write_text("{}\n")
    (base / "AA_part1" / "errors.jsonl").write_text("{}\n")

    def drain():
        stream_outputs(landing_outputs(spark, str(base), max_files=1), table, checkpoint).awaitTermination()
        return as_rows(read_annotations(spark, table), "custom_id", "demand", "level", "finish_reason", "model_response")

    first = drain()
    assert first == as_rows(annotate_long(read_outputs(spark, str(base)))) and len(first) == 10
    assert drain() == first
    land(base, "AB", range(5))
    land(base, "CD", range(3))
    assert drain() == as_rows(annotate_long(read_outputs(spark, str(base))))


def test_usage_follows_the_landing_files(spark, tmp_path, as_rows):
    base, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def drain():
        stream_usage(landing_outputs(spark, str(base), "*.jsonl", max_files=1), table, checkpoint).awaitTermination()
        return as_rows(read_usage(spark, table))

    land(base, "AA", range(10), "a.jsonl")
    land(base, "AB", range(4), "a.jsonl")
    assert drain() == as_rows(batch_usage(read_outputs(spark, str(base), "*.jsonl")))
    # A part that gets a second file later.
    land(base, "AA", range(10, 30), "b.jsonl", "o3")
    expected = as_rows(batch_usage(read_outputs(spark, str(base), "*.jsonl")))
    assert drain() == expected
    assert drain() == expected
    assert [row[2] for row in expected if row[1] == "AA"] == ["o3-29"]
    # Compaction changes nothing, nor does a second one, and what comes later is added.
    for _ in range(2):
        compact_usage(spark, table)
        assert as_rows(read_usage(spark, table)) == expected
    assert len(os.listdir(table)) == 1
    land(base, "AB", range(4, 9), "b.jsonl")
    assert drain() == as_rows(batch_usage(read_outputs(spark, str(base), "*.jsonl")))


def test_late_status_loses(spark, tmp_path, as_rows):
    schema = "batch_id string, status string, ts long, event_id long"
    source, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def add(*events):
        spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(source)
        stream_status(spark.readStream.schema(schema).parquet(source), table, checkpoint).awaitTermination()
        return as_rows(read_status(spark, table), "batch_id", "status")

    assert add(("a", "validating", 1, 1), ("b", "in_progress", 2, 2)) == [("a", "validating"), ("b", "in_progress")]
    assert add(("a", "completed", 9, 4)) == [("a", "completed"), ("b", "in_progress")]
    compact_status(spark, table)
    assert as_rows(read_status(spark, table), "batch_id", "status") == [("a", "completed"), ("b", "in_progress")]
    assert add(("a", "in_progress", 5, 5), ("b", "failed", 2, 3)) == [("a", "completed"), ("b", "failed")]
    assert as_rows(latest_status(spark.read.parquet(source)), "batch_id", "status") == [("a", "completed"), ("b", "failed")]
    assert pending(read_status(spark, table)).count() == 0
