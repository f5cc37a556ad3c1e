"""How much is written, and in files of which size."""

from pathlib import Path

from pyspark.sql import functions as F

from annomill.plans import derived, queries
from annomill.session import files_open_together
from annomill.sinks import annotations
from annomill.sinks.requests import write_requests
from annomill.sources.rubrics import read_rubric_files
from annomill.streaming.epochs import write_epoch
from annomill.streaming.wide import WideTable
from test_oracles import plan_of

TEXT = "some words that are neither rare nor few, with a \"quote\", a comma\nand a line break "


def documents(spark, path, n=300, files=1):
    rows = spark.range(n, numPartitions=files).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit(TEXT), 20).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(20 * len(TEXT)).cast("long").alias("n_chars"))
    rows.write.parquet(f"{path}/documents.parquet")
    return str(path)


def size(folder, pattern):
    return sum(file.stat().st_size for file in Path(folder.removeprefix("file:")).rglob(pattern))


def test_derived_answers_are_compressed_and_whole(spark, tmp_path):
    sf_dir = documents(spark, tmp_path)
    plain = 4 * 300 * 20 * len(TEXT)
    for write, pattern, wanted in (
            (derived.landed, "*.json*", 1200), (derived.landed_runs, "*.json*", 1200), (derived.landed_broken, "*.txt*", 1200)):
        base = write(spark, sf_dir)
        assert 0 < size(base, f"part-*{pattern[1:]}") < plain / 2
        lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(base)
        assert lines.count() == wanted


def test_open_files_need_no_sort(spark, tmp_path):
    rows = spark.range(1000, numPartitions=1).select("id", (F.col("id") % 7).alias("k"))
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    with files_open_together(spark, 8):
        rows.write.partitionBy("k").json(str(tmp_path / "open"))
    assert spark.conf.get(name, None) == before
    assert spark.read.json(str(tmp_path / "open")).count() == 1000
    with files_open_together(spark, 3):
        rows.write.partitionBy("k").json(str(tmp_path / "few"))
    assert spark.read.json(str(tmp_path / "few")).distinct().count() == 1000


def test_parallel_csv_prompts_are_written_by_many_tasks(spark, tmp_path):
    sf_dir = documents(spark, tmp_path, files=3)
    rows = queries.read_prompts_csv_parallel(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, "prompts-whole-csv")
    files = list(Path(derived._WRITTEN[key].removeprefix("file:")).glob("part-*.csv"))
    assert len(files) > 1
    assert sorted(int(r.custom_id) for r in rows.collect()) == list(range(300))
    assert "Coalesce" not in plan_of(rows)


def test_csv_annotations_lie_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(annotations, "CSV_FILE_ROWS", 100, raising=False)
    rows = spark.range(1000, numPartitions=1).select(F.col("id").cast("string").alias("custom_id"), F.lit(TEXT).alias("model_response"))
    annotations.write_annotations(rows, str(tmp_path / "csv"), "csv")
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 10
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_request_files_may_be_compressed(spark, tmp_path):
    prompts = spark.range(50).select(F.col("id").cast("string").alias("custom_id"), F.lit(TEXT).alias("prompt"))
    for name, codec in (("plain", None), ("small", "gzip")):
        write_requests(prompts, derived.rubrics(spark), str(tmp_path / name), max_lines=20, compression=codec)
    plain, small = (sorted(r.value for r in spark.read.text(str(tmp_path / name)).select("value").collect()) for name in ("plain", "small"))
    assert plain == small and len(plain) == 200
    assert size(str(tmp_path / "small"), "part-*") < size(str(tmp_path / "plain"), "part-*") / 2


def test_requests_under_a_byte_limit_are_written_compressed(spark, tmp_path):
    rows = queries.write_requests_bytes(spark, documents(spark, tmp_path))
    assert all(name.endswith(".json.gz") for name in rows.inputFiles())
    assert rows.count() == 4 * 300 and rows.select("demand", "custom_id").distinct().count() == 4 * 300


def test_rubric_folders_are_listed_by_few_tasks(spark, tmp_path):
    rows = queries.load_rubrics(spark, documents(spark, tmp_path))
    folder = derived._WRITTEN[(spark.sparkContext.applicationId, str(tmp_path), "rubrics")]
    assert rows.count() == 270
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, context = spark.conf.get(name), spark.sparkContext
    context.setJobGroup("listing", "")
    try:
        read_rubric_files(spark, folder)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(i) for job in tracker.getJobIdsForGroup("listing") for i in tracker.getJobInfo(job).stageIds]
    assert 0 < max(stage.numTasks for stage in stages) <= 4 * context.defaultParallelism
    assert spark.conf.get(name) == before


def test_micro_batches_are_dealt_by_id_alone_and_kept_small(spark, tmp_path):
    rows = derived.outputs(spark, documents(spark, tmp_path / "tables")).withColumn("run", F.lit("r"))
    table = WideTable(spark, str(tmp_path / "wide"), derived.ACRONYMS, 8)
    for epoch in (0, 1):
        write_epoch(table.partials(rows.where(F.col("file_pos") % 2 == epoch)), table.path, epoch)
    assert list((tmp_path / "wide" / "epoch=0").glob("*.zstd.parquet"))
    plan = plan_of(table.rows())
    assert "hashpartitioning(custom_id" in plan and "hashpartitioning(run" not in plan
    table.upsert()
    assert table.rows().count() == 300
