"""Annotation-run tables that Spark derives from the given tables.

The given tables hold no model answers, so answers, jobs and rubric files are
made from ``documents``, ``events`` and ``conversations`` row by row.  Every
one of them grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..session import files_open_together, new_scratch

# Demands the derived answers are about: acronym, number, name.
DEMANDS = [
    ("AA", 0, "Alpha Demand"),
    ("AB", 1, "Beta Demand"),
    ("CD", 2, "Gamma Demand"),
    ("CE", 3, "Delta Demand"),
]
ACRONYMS = [acronym for acronym, _, _ in DEMANDS]

# Model names for the price lookup; one matches no key.
MODEL_NAMES = ["gpt-4o-mini-2024", "gpt-5-mini", "o4-mini", "gpt-4o-global-batch", "zzz"]

# Job status for each kind of event.
STATUS_OF_EVENT = [
    ("purchase", "completed"),
    ("error", "failed"),
    ("view", "in_progress"),
    ("signup", "validating"),
    ("click", "finalizing"),
]


def rubric_text(name: str) -> str:
    lines = [f"How much {name} a task asks for."]
    for level in range(6):
        lines.append(f"\nLevel {level}. A task at step {level} of {name}.\nExamples:\n* \"{name}, task {level}\"")
    return "\n".join(lines)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rubrics(spark: SparkSession) -> DataFrame:
    rows = [(acronym, name, rubric_text(name), f"{acronym}.txt") for acronym, _, name in DEMANDS]
    return spark.createDataFrame(rows, "acronym string, full_name string, content string, file_path string")


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("custom_id"), F.col("text").alias("prompt")
    )


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat output rows: every document answered for every demand."""
    demands = F.array(*[
        F.struct(F.lit(a).alias("acronym"), F.lit(n).alias("ord"), F.lit(name).alias("full_name"))
        for a, n, name in DEMANDS
    ])
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", F.explode(demands).alias("r"))
    doc, number = F.col("doc_id"), F.col("r.ord")
    reason = (doc + number) % 10
    score = (doc * 7 + number * 3) % 9
    even = doc % 2 == 0
    part = F.concat("r.acronym", F.when(even, "_part1").otherwise("_part2"))
    return rows.select(
        doc.cast("string").alias("custom_id"),
        F.col("r.acronym").alias("demand"),
        part.alias("part"),
        F.when(even, "gpt-4o-mini-2024-07-18").otherwise("o4-mini-2025-04-16").alias("model"),
        F.lit(True).alias("has_choice"),
        F.when(reason == 8, "length").when(reason == 9, "content_filter").otherwise("stop")
        .alias("finish_reason"),
        F.concat(
            "text", F.lit("\n\nThus, the level of *"), "r.full_name",
            F.lit("* demanded by the given TASK INSTANCE is: "),
            F.when(score == 8, "Not Applicable").otherwise(score.cast("string")),
        ).alias("content"),
        F.floor(F.col("n_chars") / 4).alias("prompt_tokens"),
        (20 + (doc * 13 + number * 5) % 200).alias("completion_tokens"),
        F.lit(None).cast("string").alias("corrupt_record"),
        part.alias("file_path"),
        F.lit(0).cast("bigint").alias("file_block"),
        doc.alias("file_pos"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch metadata per part of ``outputs``."""
    return metadata_of(outputs(spark, sf_dir))


def metadata_of(answers: DataFrame, *run: str) -> DataFrame:
    """Batch metadata per part, and per run if there are several."""
    first, tokens = F.col("first"), F.col("tokens")
    failed_part = F.col("demand") == "CD"
    return (
        answers.groupBy(*run, "demand", "part")
        .agg(
            F.count("*").alias("n"), F.min("file_pos").alias("first"),
            F.sum("completion_tokens").alias("tokens"),
            F.count_if(F.col("finish_reason") == "content_filter").alias("refused"),
        )
        .select(
            *run, "demand", "part",
            F.concat(F.lit("batch_"), *run, "part").alias("id"),
            F.when(failed_part, "failed").when(F.col("demand") == "CE", "in_progress")
            .otherwise("completed").alias("status"),
            (first + 1700000000).alias("created_at"),
            F.when(F.col("demand") != "CE", first + 1700000000 + tokens % 9973).alias("completed_at"),
            F.concat(F.lit("out_"), "part").alias("output_file_id"),
            F.when(failed_part, F.concat(F.lit("err_"), "part")).alias("error_file_id"),
            F.struct(
                F.col("n").alias("total"), (F.col("n") - F.col("refused")).alias("completed"),
                F.col("refused").alias("failed"),
            ).alias("request_counts"),
            F.when(failed_part, "refused requests").alias("errors"),
        )
    )


def epoch_seconds(ts):
    """Seconds since 1970 of a zone-less time, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def status_events(events: DataFrame) -> DataFrame:
    """``events`` as job status events; works on a stream too."""
    status = F
    for kind, name in STATUS_OF_EVENT:
        status = status.when(F.col("event_type") == kind, name)
    return events.select(
        F.concat(F.lit("batch_"), F.col("user_id").cast("string")).alias("batch_id"),
        status.alias("status"), "ts", "event_id", "user_id", "event_type",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per user: the latest event is its status."""
    events = status_events(table(spark, sf_dir, "events"))
    kind = F.col("event_type")
    return (
        events.groupBy("batch_id")
        .agg(
            F.max(F.struct("ts", "event_id", "status")).alias("last"),
            F.min("ts").alias("start"),
            F.count("*").alias("total"),
            F.count_if(kind.isin("purchase", "view")).alias("completed"),
            F.count_if(kind == "error").alias("failed"),
        )
        .select(
            F.col("batch_id").alias("id"),
            F.col("last.status").alias("status"),
            epoch_seconds(F.col("start")).alias("created_at"),
            F.when(F.col("last.status").isin("completed", "failed"),
                   epoch_seconds(F.col("last.ts"))).alias("completed_at"),
            F.struct("total", "completed", "failed").alias("request_counts"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part and batch for every user whose first event is no error."""
    events = table(spark, sf_dir, "events")
    names = F.array(*[F.lit(a) for a in ACRONYMS])
    demand = F.element_at(names, (F.col("user_id") % len(ACRONYMS) + 1).cast("int"))
    user = F.col("user_id").cast("string")
    return (
        events.groupBy("user_id").agg(F.min(F.struct("ts", "event_id", "event_type")).alias("first"))
        .filter(F.col("first.event_type") != "error")
        .select(
            demand.alias("demand"),
            F.concat(demand, F.lit("_part"), user).alias("part"),
            F.concat(F.lit("batch_"), user).alias("batch_id"),
        )
    )


def rubric_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rubric file's text per document, with its whole text in level 0: ``acronym, value``.

    Files of documents whose number ends in 7 miss the hash sign.
    """
    doc = F.col("doc_id").cast("string")
    later = "".join(f"Level {k}: more\r\nExamples: none\r\n" for k in range(1, 6))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), doc).alias("acronym"),
        F.concat(F.when(doc.endswith("7"), "").otherwise("# "), F.lit("Document "), doc, F.lit("\r\nLevel 0: "), "text",
                 F.lit("\r\nExamples: none\r\n" + later)).alias("value"),
    )


# --- Files written from the derived tables, once per session and table set ----

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def written(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN or not _exists(spark, _WRITTEN[key]):
        path = new_scratch(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def prompt_files(spark: SparkSession, sf_dir: str, format: str) -> str:
    """Prompts with an extra column, as one of the source formats."""
    def write(path):
        rows = prompts(spark, sf_dir).withColumn("note", F.lit("not read"))
        if format == "jsonl":
            rows.write.json(path)
        elif format == "csv":
            rows.write.options(
                header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            ).csv(path)
        else:
            rows.write.parquet(path)

    return written(spark, sf_dir, f"prompts-{format}", write)


def output_lines(rows: DataFrame, *further: str) -> DataFrame:
    """Flat output rows in the shape the service delivers them."""
    body = F.struct(
        "model",
        F.array(F.struct("finish_reason", F.struct("content").alias("message"))).alias("choices"),
        F.struct("prompt_tokens", "completion_tokens").alias("usage"),
    )
    return rows.select("custom_id", F.struct(body.alias("body")).alias("response"), "part", *further)


#: Files that one task may write at once; there are 16 parts at most.
OPEN_FILES = 64


def compressed(rows: DataFrame) -> DataFrameWriter:
    """Answers repeat every text for each demand, so they are kept small; the fastest level does."""
    return rows.write.options(compression="gzip", **{"zlib.compress.level": "BEST_SPEED"})


def landed(spark: SparkSession, sf_dir: str) -> str:
    """``outputs/part=<part>/*.json.gz``."""
    def write(path):
        with files_open_together(spark, OPEN_FILES):
            compressed(output_lines(outputs(spark, sf_dir))).partitionBy("part").json(f"{path}/outputs")

    return written(spark, sf_dir, "landed", write)


def landed_broken(spark: SparkSession, sf_dir: str) -> str:
    """Outputs with bad lines in the parts of one demand: refused answers are
    cut short, and answers that ran out of length claim to have stopped but
    have no text.  Each task writes its rows of every part to files of its own."""
    def write(path):
        rows = outputs(spark, sf_dir)
        here = F.col("demand") == "AB"
        lost = here & (F.col("finish_reason") == "length")
        cut = here & (F.col("finish_reason") == "content_filter")
        rows = rows.withColumn("content", F.when(~lost, F.col("content"))).withColumn(
            "finish_reason", F.when(lost, "stop").otherwise(F.col("finish_reason"))
        )
        line = F.to_json(F.struct("custom_id", "response"))
        lines = output_lines(rows.withColumn("part", F.struct("part", cut.alias("cut")))).select(
            F.when(F.col("part.cut"), F.substring_index(line, '"usage"', 1)).otherwise(line).alias("value"),
            F.col("part.part").alias("part"),
        )
        # The text writer names its files .txt.gz; the reader is told which to take.
        with files_open_together(spark, OPEN_FILES):
            compressed(lines).partitionBy("part").text(path)

    return written(spark, sf_dir, "landed-broken", write)


def landed_runs(spark: SparkSession, sf_dir: str) -> str:
    """``run=<run>/part=<part>/``: answers as ``*.json.gz``, batch metadata as ``*.txt``; both runs have the same parts."""
    def write(path):
        run = F.when(F.col("file_pos") % 3 == 0, "run2").otherwise("run1")
        answers = outputs(spark, sf_dir).withColumn("run", run)
        with files_open_together(spark, OPEN_FILES):
            compressed(output_lines(answers, "run")).partitionBy("run", "part").json(path)
        about = metadata_of(answers, "run")
        fields = [name for name in about.columns if name not in ("run", "demand", "part")]
        about.select(F.to_json(F.struct(*fields)).alias("value"), "run", "part").write.partitionBy(
            "run", "part").mode("append").text(path)

    return written(spark, sf_dir, "landed-runs", write)
