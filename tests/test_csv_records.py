"""One CSV file in many tasks against the reader that takes it in one."""

import csv
import random

import pytest

from annomill.operators.positions import with_file_index
from annomill.sources.csv_records import csv_records, read_csv_records
from annomill.sources.prompts import prompts_only, read_prompts

PIECES = ["a", "word", " ", ",", '"', "\n", "\r\n", "é中", "", "'", "\\", '""', "\n\n", ";", "\t", "x" * 70]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "100b", "spark.sql.files.openCostInBytes": "1b"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def write_csv(path, rows, end="\n", header=("note", "prompt", "custom_id")):
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([header, *rows])
    return str(path)


def made(seed, count, longest=8):
    rng = random.Random(seed)
    return [("n", "".join(rng.choice(PIECES) for _ in range(rng.randint(1, longest))) or "p", str(i)) for i in range(count)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("in_memory", [1 << 17, 0])
def test_same_as_in_one_task(spark, tmp_path, as_rows, small_splits, end, in_memory):
    rows = made(end, 120) + [("long", "line\n" * 200 + 'said "x"', "L"), ("", "", "E"), ("n", " lead", "S")]
    path = write_csv(tmp_path / "p.csv", rows, end)
    write_csv(tmp_path / "q.csv", made("other", 30), end)
    one = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "*.csv"))
    many = read_csv_records(spark, str(tmp_path / "*.csv"), one.columns, in_memory)
    assert as_rows(many, "note", "prompt", "custom_id") == as_rows(one)
    assert many.count() == 153
    # A record's text moves only where it crosses a split.
    assert csv_records(spark, path, in_memory).select("file_block").distinct().count() > 20


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    path = write_csv(tmp_path / "p.csv", made(3, 300))
    frame = read_prompts(spark, path, "csv", multiline="parallel")
    assert frame.rdd.getNumPartitions() > 30
    assert read_prompts(spark, path, "csv").rdd.getNumPartitions() == 1


def test_positions_have_no_gaps(spark, tmp_path, as_rows, small_splits):
    rows = made(4, 80)
    path = tmp_path / "p.csv"
    write_csv(path, rows)
    text = path.read_text("utf-8").split("\n", 1)
    # Blank lines between records are none.
    path.write_text(text[0] + "\n\n\n" + text[1] + "\n\n", "utf-8")
    numbered = with_file_index(read_prompts(spark, str(path), "csv", multiline="parallel", position=True))
    assert [r.custom_id for r in numbered.sort("row_index").collect()] == [str(i) for i in range(80)]
    assert {r.n_rows for r in numbered.collect()} == {80}


def test_odd_files(spark, tmp_path, as_rows, small_splits):
    def read(text, **options):
        path = tmp_path / "p.csv"
        path.write_text(text, "utf-8", newline="")
        return as_rows(read_prompts(spark, str(path), "csv", multiline="parallel", **options), "custom_id", "prompt")

    assert read("custom_id,prompt\n1,a") == [("1", "a")]
    assert read("custom_id,prompt\r\n1,\"a\r\nb\"\r\n") == [("1", "a\nb")]
    assert read('﻿custom_id,prompt\n1,a\n"2","b"""\n') == [("1", "a"), ("2", "b\"")]
    assert read('custom_id,prompt\n1,a\n2\n3,c,more\n', mode="quarantine") == [("1", "a"), ("3", "c")]
    assert read("custom_id,prompt\n") == []
    assert read('custom_id,prompt\n' + '1,"' + "x\n" * 400 + '"') == [("1", "x\n" * 400)]
    with pytest.raises(Exception, match="lacks"):
        read("custom_id,prompt\n1,a\n,b\n")
    for broken in ('1,5" pipe\n2,b\n', '1,a\n2," "b"\n', '1,"never closed\n' + "2,b\n" * 60):
        with pytest.raises(Exception, match="a quote within a field"):
            read("custom_id,prompt\n" + broken)


def test_headers_must_agree(spark, tmp_path, small_splits):
    write_csv(tmp_path / "a.csv", [("1", "x")], header=("custom_id", "prompt"))
    write_csv(tmp_path / "b.csv", [("1", "x")], header=("prompt", "custom_id"))
    with pytest.raises(Exception, match="header"):
        prompts_only(spark, str(tmp_path / "*.csv"), "csv", multiline="parallel").collect()
    with pytest.raises(KeyError):
        read_prompts(spark, write_csv(tmp_path / "c.csv", [("1",)], header=("custom_id",)), "csv", multiline="parallel")
