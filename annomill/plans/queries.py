"""Every operator as a query over the given tables.

Each callable takes ``(spark, sf_dir)``.  Long texts that many rows share are
returned as MD5 and byte length of the whole text.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import TokenCounter
from ..operators import (
    annotate, lookups, positions, requests, reshape, splitting, tokens, usage, validation,
)
from ..sinks.annotations import write_annotations
from ..sinks.requests import write_requests as write_request_files
from ..sources import jobs as job_files
from ..sources import outputs as output_files
from ..sources import prompts as prompt_files
from ..sources import rubrics as rubric_files
from ..streaming import outputs as output_stream
from ..streaming import status as status_stream
from ..streaming import summaries as summary_stream
from ..streaming import tracking
from ..streaming.wide import WideTable
from ..session import new_scratch, stored
from . import derived as d
from .runs import collect_run, create_requests

# Limits under which the derived requests split.
MAX_LINES = 300
MAX_BYTES = 1_000_000
COST_MODELS = ["gpt-4o", "o4-mini", "gpt-3.5-turbo"]
PREFIXES = ["A", "CD_part1", "XY"]
WRITTEN_GLOB = "*.json*"


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_name(label: str) -> str:
    """A name in the session's catalogue that nothing has used yet."""
    return f"annomill_{label}_{uuid.uuid4().hex}"


def _digest(text: str, name: str):
    return [F.md5(F.col(text)).alias(f"{name}_md5"), F.octet_length(text).alias(f"{name}_bytes")]


def _long(spark, sf_dir, **options):
    return annotate.annotate_long(d.outputs(spark, sf_dir), **options)


# --- Sources -----------------------------------------------------------------

def read_prompts_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_files.read_prompts(spark, d.prompt_files(spark, sf_dir, "jsonl"), "jsonl")


def read_prompts_csv(spark, sf_dir):
    return prompt_files.read_prompts(spark, d.prompt_files(spark, sf_dir, "csv"), "csv")


def read_prompts_csv_parallel(spark, sf_dir):
    """CSV files of all prompts, with their line breaks, each read by many tasks."""
    path = d.written(spark, sf_dir, "prompts-whole-csv", lambda path: (
        d.prompts(spark, sf_dir).write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    ))
    return prompt_files.read_prompts(spark, path, "csv", multiline="parallel")


def read_prompts_parquet(spark, sf_dir):
    return prompt_files.read_prompts(spark, d.prompt_files(spark, sf_dir, "parquet"), "parquet")


def prompts_only(spark, sf_dir):
    return prompt_files.prompts_only(spark, d.prompt_files(spark, sf_dir, "parquet"), "parquet")


def load_rubrics(spark, sf_dir):
    folder = d.written(spark, sf_dir, "rubrics", lambda path: (
        d.rubric_files(spark, sf_dir).write.partitionBy("acronym").text(path)
    ))
    return rubric_files.load_rubrics(spark, folder).select(
        "acronym", "full_name", *_digest("content", "content")
    )


def read_outputs(spark, sf_dir):
    rows = output_files.read_outputs(spark, d.landed(spark, sf_dir), WRITTEN_GLOB)
    return rows.select(
        "custom_id", "demand", "part", "model", "finish_reason",
        "prompt_tokens", "completion_tokens", *_digest("content", "content"),
    )


def part_inventory(spark, sf_dir):
    return output_files.part_inventory(spark, d.landed(spark, sf_dir), WRITTEN_GLOB).drop("run")


def read_errors(spark, sf_dir):
    def write(path):
        refused = d.outputs(spark, sf_dir).filter(F.col("finish_reason") == "content_filter")
        error = F.struct(F.lit("content_filter").alias("code"), F.col("model").alias("model"))
        refused.select("custom_id", error.alias("error"), "part").write.partitionBy("part").json(path)

    base = d.written(spark, sf_dir, "errors", write)
    return job_files.read_errors(spark, base, WRITTEN_GLOB).select("demand", "part", "custom_id", "error")


def read_errors_whole(spark, sf_dir):
    """Error lines that hold a response instead of an error, and lines that are cut short."""
    def write(path):
        refused = d.outputs(spark, sf_dir).filter(F.col("finish_reason") == "content_filter")
        line = F.to_json(F.struct("custom_id", F.struct(F.lit(400).alias("status_code")).alias("response")))
        cut = F.when(F.col("file_pos") % 4 == 0, F.substring_index(line, "}", 1)).otherwise(line)
        refused.select(cut.alias("value"), "part").write.partitionBy("part").text(path)

    base = d.written(spark, sf_dir, "errors-whole", write)
    return job_files.read_errors(spark, base, "*.txt").select(
        "demand", "part", "custom_id", "error", "response", "corrupt_record")


def _mixed_errors(spark, sf_dir):
    """Refused requests as error lines of five shapes, one of them cut short."""
    def write(path):
        refused = d.outputs(spark, sf_dir).filter(F.col("finish_reason") == "content_filter")
        about = F.struct(F.col("content").alias("message"), F.lit("policy").alias("type"))
        shape = F.col("file_pos") % 5
        lines = [
            F.struct("custom_id", F.struct(F.lit("content_filter").alias("code"), F.col("content").alias("message")).alias("error")),
            F.struct("custom_id", F.struct(F.lit(400).alias("status_code"), F.struct(about.alias("error")).alias("body")).alias("response")),
            F.struct("custom_id", F.col("content").alias("error")),
            F.struct("custom_id", F.struct(F.col("completion_tokens").alias("code")).alias("error"), F.lit(429).alias("status_code")),
        ]
        line = F.substring_index(F.to_json(lines[0]), '"error"', 1)
        for number, one in enumerate(lines):
            line = F.when(shape == number, F.to_json(one)).otherwise(line)
        refused.select(line.alias("value"), "part").write.partitionBy("part").text(path)

    return d.written(spark, sf_dir, "errors-mixed", write)


def read_error_details(spark, sf_dir):
    rows = job_files.read_error_details(spark, _mixed_errors(spark, sf_dir), "*.txt")
    return rows.select("demand", "part", "custom_id", "status_code", "code", *_digest("message", "message"), "corrupt_record")


def shape_of_errors(spark, sf_dir):
    rows = job_files.read_error_details(spark, _mixed_errors(spark, sf_dir), "*.txt")
    return job_files.shape_of_errors(rows, "part")


def read_batch_metadata(spark, sf_dir):
    base = d.written(spark, sf_dir, "metadata", lambda path: (
        d.metadata(spark, sf_dir).drop("demand").repartition("part").write.partitionBy("part").json(path)
    ))
    rows = job_files.read_batch_metadata(spark, base, WRITTEN_GLOB)
    return rows.select(
        "demand", "part", "id", "status", "created_at", "completed_at", "output_file_id",
        "error_file_id", F.col("request_counts.total").alias("total"),
        F.col("request_counts.completed").alias("completed"),
        F.col("request_counts.failed").alias("failed"), "errors",
    )


def job_ledger(spark, sf_dir):
    path = d.written(spark, sf_dir, "ledger", lambda path: (
        job_files.write_job_ledger(d.ledger(spark, sf_dir), path)
    ))
    return job_files.read_job_ledger(spark, path)


# --- Sinks -------------------------------------------------------------------

def write_requests(spark, sf_dir):
    path = new_scratch(spark, "requests")
    write_request_files(
        d.prompts(spark, sf_dir), d.rubrics(spark), path, max_lines=MAX_LINES, max_bytes=None, compression="gzip"
    )
    schema = ("custom_id string, method string, url string, body struct<model string, "
              "messages array<struct<role string, content string>>, max_tokens int, temperature int>, "
              "demand string, part string")
    rows = spark.read.schema(schema).json(path)
    return rows.withColumn("content", F.col("body.messages")[1]["content"]).select(
        "demand", "part", "custom_id", *_digest("content", "content")
    )


def write_requests_bytes(spark, sf_dir):
    """From files to files, in the order of the files, under a byte limit alone."""
    folder = d.written(spark, sf_dir, "rubric-texts", lambda path: (
        d.rubrics(spark).select("acronym", F.concat(F.lit("# "), "full_name", F.lit("\n"), "content").alias("value"))
        .write.partitionBy("acronym").text(path)
    ))
    path = new_scratch(spark, "requests-bytes")
    create_requests(spark, d.prompt_files(spark, sf_dir, "jsonl"), folder, path, max_lines=None, max_bytes=MAX_BYTES, compression="gzip")
    schema = "custom_id string, body struct<messages: array<struct<role: string, content: string>>>, demand string, part string"
    rows = spark.read.schema(schema).json(path)
    return rows.select("demand", "part", "custom_id", F.col("body.messages")[1]["content"].alias("content")).select(
        "demand", "part", "custom_id", *_digest("content", "content"))


def write_requests_exact(spark, sf_dir):
    """Lines and bytes of request files none of which may be larger than allowed, as they lie."""
    path = new_scratch(spark, "requests-exact")
    write_request_files(
        d.prompts(spark, sf_dir), d.rubrics(spark), path, max_lines=MAX_LINES, max_bytes=MAX_BYTES, cuts="exact",
        compression="gzip")
    lines = spark.read.text(path)
    return lines.groupBy("demand", "part").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min(F.get_json_object("value", "$.custom_id")).alias("first_id"),
        F.max(F.get_json_object("value", "$.custom_id")).alias("last_id"))


def _written_annotations(spark, sf_dir, format, split=False):
    path = new_scratch(spark, f"annotations-{format}")
    write_annotations(annotate.nan_levels(_long(spark, sf_dir)), path, format, split)
    return path


_LONG_SCHEMA = "custom_id string, demand string, level double, finish_reason string, model_response string"


def _read_back(rows):
    level = F.when(~F.isnan("level"), F.col("level"))
    return rows.select(
        "custom_id", "demand", level.alias("level"), "finish_reason",
        *_digest("model_response", "response"),
    )


def write_annotations_jsonl(spark, sf_dir):
    path = _written_annotations(spark, sf_dir, "jsonl")
    return _read_back(spark.read.schema(_LONG_SCHEMA).json(path))


def write_annotations_csv(spark, sf_dir):
    path = _written_annotations(spark, sf_dir, "csv")
    options = {"header": True, "escape": '"', "multiLine": True}
    return _read_back(spark.read.schema(_LONG_SCHEMA).options(**options).csv(path))


def write_annotations_parquet(spark, sf_dir):
    return _read_back(spark.read.parquet(_written_annotations(spark, sf_dir, "parquet")))


def split_by_demand(spark, sf_dir):
    path = _written_annotations(spark, sf_dir, "jsonl", split=True)
    # Partition values take the type the schema gives them.
    return _read_back(spark.read.schema(_LONG_SCHEMA).json(path))


def write_annotations_kept(spark, sf_dir):
    """What a folder holds after a good write and two that failed."""
    path = _written_annotations(spark, sf_dir, "parquet")
    rows = annotate.nan_levels(_long(spark, sf_dir))
    broken = F.when(F.col("custom_id") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("custom_id"))
    for failing in (rows.where("demand = 'none'"), rows.withColumn("custom_id", broken)):
        try:
            write_annotations(failing, path, "parquet")
        except (ValueError, PySparkException):
            continue
        raise RuntimeError("a write that cannot succeed did")
    return _read_back(spark.read.parquet(path))


# --- Projections and filters ---------------------------------------------------

def render_instruction(spark, sf_dir):
    rows = requests.render_requests(d.prompts(spark, sf_dir), d.rubrics(spark))
    return rows.select("custom_id", "demand", *_digest("instruction", "instruction"))


def build_request(spark, sf_dir):
    rows = requests.build_requests(d.prompts(spark, sf_dir), d.rubrics(spark))
    user = F.col("body.messages")[1]
    line = F.to_json(F.struct("custom_id", "method", "url", "body"))
    return rows.select(
        "custom_id", "demand", "method", "url", F.col("body.model").alias("model"),
        F.col("body.messages")[0]["role"].alias("system_role"),
        F.col("body.messages")[0]["content"].alias("system_content"),
        user["role"].alias("user_role"), F.md5(user["content"]).alias("user_md5"),
        F.col("body.max_tokens").alias("max_tokens"), F.col("body.temperature").alias("temperature"),
        (F.octet_length(line) + 1).alias("line_bytes"),
    )


def demand_of_path(spark, sf_dir):
    rows = output_files.read_outputs(spark, d.landed(spark, sf_dir), WRITTEN_GLOB)
    return rows.groupBy("demand", "part").agg(F.count("custom_id").alias("rows"))


def extract_level(spark, sf_dir):
    rows = d.outputs(spark, sf_dir)
    return rows.select("custom_id", "demand", annotate.extract_level(F.col("content")).alias("level"))


def extract_level_guarded(spark, sf_dir):
    """A document's last paragraph is its only one, so some begin with their only number."""
    text = F.concat((F.col("doc_id") % 8).cast("string"), F.lit(". "), "text")
    rows = d.table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return rows.select(
        "doc_id", annotate.extract_level(F.col("text"), guard_section_number=True).alias("level")
    )


def annotate_long(spark, sf_dir):
    return _long(spark, sf_dir).select(
        "custom_id", "demand", "level", "finish_reason", *_digest("model_response", "response")
    )


def bad_rows(spark, sf_dir):
    """The quarantine of files in which some lines are cut short or have no text."""
    rows = annotate.bad_rows(output_files.read_outputs(spark, d.landed_broken(spark, sf_dir), "*.txt*"))
    return rows.select("demand", "part", "custom_id", "finish_reason",
                       F.octet_length("corrupt_record").alias("corrupt_bytes"))


def annotate_long_broken(spark, sf_dir):
    rows = output_files.read_outputs(spark, d.landed_broken(spark, sf_dir), "*.txt*")
    return annotate.annotate_long(rows, only_levels=True)


def annotate_long_drop_file(spark, sf_dir):
    rows = output_files.read_outputs(spark, d.landed_broken(spark, sf_dir), "*.txt*")
    return annotate.annotate_long(rows, only_levels=True, on_bad_row="drop_file")


def finish_bucket(spark, sf_dir):
    rows = annotate.with_finish_bucket(d.outputs(spark, sf_dir))
    return rows.select("custom_id", "demand", "finish_reason", "finish_bucket")


def filter_finish_reason(spark, sf_dir):
    kept = [
        _long(spark, sf_dir, finish_reason=reason, only_levels=True).withColumn("bucket", F.lit(reason))
        for reason in ("length", "other")
    ]
    return output_files.union_outputs(*kept).select("custom_id", "demand", "level", "bucket")


def filter_outcome(spark, sf_dir):
    return _long(spark, sf_dir, finish_reason="stop", only_failed=True, only_levels=True)


def filter_outcome_succeed(spark, sf_dir):
    return _long(spark, sf_dir, only_succeed=True, only_levels=True)


def only_levels(spark, sf_dir):
    return annotate.only_levels(_long(spark, sf_dir))


def filter_demands(spark, sf_dir):
    chosen = requests.filter_demands(d.rubrics(spark), ["AA", "CE"])
    return requests.expand_requests(d.prompts(spark, sf_dir), chosen).select("custom_id", "demand")


def filter_demands_prefix(spark, sf_dir):
    rows = requests.filter_demands_prefix(d.outputs(spark, sf_dir), PREFIXES)
    return rows.select("custom_id", "part")


def filter_demands_substring(spark, sf_dir):
    rows = requests.filter_demands_prefix(d.outputs(spark, sf_dir), ["B_part1", "CE"], anywhere=True)
    return rows.select("custom_id", "part")


def unmatched_prefixes(spark, sf_dir):
    return requests.unmatched_prefixes(d.outputs(spark, sf_dir), PREFIXES)


# --- Joins -------------------------------------------------------------------

def expand_requests(spark, sf_dir):
    rows = requests.expand_requests(d.prompts(spark, sf_dir), d.rubrics(spark))
    return rows.select("custom_id", "demand", "full_name", F.octet_length("prompt").alias("prompt_bytes"))


def _conversation_prompts(spark, sf_dir):
    return d.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("custom_id"), F.col("text").alias("prompt"), "turn"
    )


def prompt_map(spark, sf_dir):
    return prompt_files.prompt_map(_conversation_prompts(spark, sf_dir), F.col("turn"))


def attach_prompts(spark, sf_dir):
    rows = _long(spark, sf_dir, only_levels=True)
    return lookups.attach_prompts(rows, _conversation_prompts(spark, sf_dir), F.col("turn"))


def attach_prompts_hot(spark, sf_dir):
    """Annotations by language, of which one holds most: its rows go to many slices."""
    prompts = d.table(spark, sf_dir, "documents").select(
        F.col("lang").alias("custom_id"), F.col("text").alias("prompt"), "doc_id"
    )
    languages = d.table(spark, sf_dir, "documents").select(F.col("lang").alias("custom_id"), "doc_id")
    joined = lookups.attach_prompts(languages, prompts, F.col("doc_id"), slice_rows=100)
    return joined.select("doc_id", "custom_id", *_digest("prompt", "prompt"))


def price_lookup(spark, sf_dir):
    names = F.array(*[F.lit(name) for name in d.MODEL_NAMES])
    model = F.element_at(names, (F.col("doc_id") % len(d.MODEL_NAMES) + 1).cast("int"))
    rows = d.table(spark, sf_dir, "documents").select("doc_id", model.alias("model"))
    first = lookups.price_lookup(rows).withColumn("match", F.lit("first"))
    longest = lookups.price_lookup(rows, match="longest").withColumn("match", F.lit("longest"))
    return first.unionByName(longest)


def jobs_in_ledger(spark, sf_dir):
    found = lookups.jobs_in_ledger(d.jobs(spark, sf_dir), d.ledger(spark, sf_dir), "completed")
    return found.select("id", "status", "demand", "part", "created_at", "completed_at")


def completed_jobs(spark, sf_dir):
    return lookups.completed_jobs(d.ledger(spark, sf_dir), d.jobs(spark, sf_dir))


def completed_jobs_by_output(spark, sf_dir):
    """Batches whose part has landed."""
    launched = d.metadata(spark, sf_dir).select("demand", "part", F.col("id").alias("batch_id"))
    delivered = d.outputs(spark, sf_dir).filter("demand != 'CE'")
    return lookups.completed_by_output(launched, delivered)


def missing_outputs(spark, sf_dir):
    """Pairs whose request was refused have no output."""
    delivered = d.outputs(spark, sf_dir).filter(F.col("finish_reason") != "content_filter")
    return lookups.missing_annotations(d.prompts(spark, sf_dir), delivered, d.ACRONYMS)


def missing_output_parts(spark, sf_dir):
    """Launched parts whose batch has not completed."""
    launched = d.ledger(spark, sf_dir)
    return lookups.missing_parts(launched, lookups.completed_jobs(launched, d.jobs(spark, sf_dir)))


def unknown_demands(spark, sf_dir):
    sources = d.table(spark, sf_dir, "documents").select(F.col("source").alias("acronym"))
    return lookups.unknown_demands(["src1", "src99", "AA"], sources)


# --- Aggregations --------------------------------------------------------------

def annotation_summary(spark, sf_dir):
    return usage.annotation_summary(_long(spark, sf_dir, only_levels=True), "demand")


def annotation_summary_total(spark, sf_dir):
    return usage.annotation_summary(_long(spark, sf_dir, only_levels=True))


def failed_breakdown(spark, sf_dir):
    return usage.failed_breakdown(_long(spark, sf_dir))


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        rows = rows.withColumn(name, F.round(name, 6))
    return rows


def _usage(spark, sf_dir):
    return usage.batch_usage(d.outputs(spark, sf_dir))


def batch_usage_files(spark, sf_dir):
    """From the landed files, without decoding the answers."""
    rows = output_files.read_outputs(spark, d.landed(spark, sf_dir), WRITTEN_GLOB, content=False)
    return usage.batch_usage(rows).drop("run", "stop", "length", "other")


def batch_usage(spark, sf_dir):
    return _usage(spark, sf_dir).drop("stop", "length", "other")


def finish_reason_counts(spark, sf_dir):
    return usage.finish_reason_counts(_usage(spark, sf_dir))


def batch_cost(spark, sf_dir):
    return usage.batch_cost(_usage(spark, sf_dir)).select(
        "part", "model", "cost_prompt", "cost_completion", "cost_total"
    )


def _summaries(spark, sf_dir):
    return usage.batch_summary(d.metadata(spark, sf_dir), _usage(spark, sf_dir))


def batch_summary(spark, sf_dir):
    return _summaries(spark, sf_dir)


def _summaries_of_runs(spark, sf_dir, answers=None):
    base = d.landed_runs(spark, sf_dir)
    if answers is None:
        answers = usage.batch_usage(output_files.read_outputs(spark, base, WRITTEN_GLOB, content=False))
    about = job_files.read_batch_metadata(spark, base, "*.txt", multiline=False)
    rows = usage.batch_summary(about, answers)
    return rows.withColumn("run", F.regexp_extract("run", "run=([^/]+)$", 1))


def batch_summary_runs(spark, sf_dir):
    """Two runs below one folder whose parts have the same names."""
    return _summaries_of_runs(spark, sf_dir)


def general_summary_runs(spark, sf_dir):
    return _general(_summaries_of_runs(spark, sf_dir))


def stream_summary_runs(spark, sf_dir):
    """The same from a stream, whose table is compacted in between."""
    landing = output_stream.landing_outputs(
        spark, d.landed_runs(spark, sf_dir), WRITTEN_GLOB, max_files=8, content=False)
    table = new_scratch(spark, "stream-usage")
    summary_stream.stream_usage(landing, table, new_scratch(spark, "usage-checkpoint")).awaitTermination()
    summary_stream.compact_usage(spark, table)
    return _general(_summaries_of_runs(spark, sf_dir, summary_stream.read_usage(spark, table)))


def annotation_summary_broken(spark, sf_dir):
    """Counts per demand with the lines set aside."""
    return collect_run(spark, d.landed_broken(spark, sf_dir), "*.txt*").summary("demand")


# Sums of doubles differ between engines in the last digits.
_GENERAL_ROUNDED = (
    "duration_std", "tokens_avg_completion", "tokens_std_completion",
    "cost_prompt", "cost_completion", "cost_total",
)


def _general(summaries):
    rows = usage.general_summary(summaries)
    for name in ("demands", "models"):
        rows = rows.withColumn(name, F.array_join(name, ","))
    return _rounded(rows, *_GENERAL_ROUNDED)


def general_summary(spark, sf_dir):
    return _general(_summaries(spark, sf_dir))


def general_summary_members(spark, sf_dir):
    return usage.summary_members(_summaries(spark, sf_dir))


def pooled_token_stats(spark, sf_dir):
    rows = usage.pooled_token_stats(_summaries(spark, sf_dir))
    return _rounded(rows, "tokens_avg_completion", "tokens_std_completion")


def status_histogram(spark, sf_dir):
    return usage.status_histogram(d.jobs(spark, sf_dir))


def batch_progress(spark, sf_dir):
    return usage.batch_progress(d.jobs(spark, sf_dir))


def token_count(spark, sf_dir):
    return tokens.token_count(d.prompts(spark, sf_dir)).select("custom_id", "tokens")


def input_tokens_exact(spark, sf_dir):
    return tokens.input_tokens_exact(d.prompts(spark, sf_dir), d.rubrics(spark))


def input_tokens_approx(spark, sf_dir):
    return tokens.input_tokens_approx(d.prompts(spark, sf_dir), d.rubrics(spark))


def input_tokens_rendered(spark, sf_dir):
    """With a counter that cuts across blanks every pair is rendered and counted: four characters are a token."""
    quarters = TokenCounter(lambda text: F.ceil(F.length(text) / 4))
    return tokens.input_tokens_exact(d.prompts(spark, sf_dir), d.rubrics(spark), quarters)


def estimate_cost(spark, sf_dir):
    return tokens.estimate_cost(d.prompts(spark, sf_dir), d.rubrics(spark), COST_MODELS)


def estimate_cost_exact(spark, sf_dir):
    return tokens.estimate_cost(
        d.prompts(spark, sf_dir), d.rubrics(spark), COST_MODELS, estimation="exact"
    )


def validate_prompts(spark, sf_dir):
    """Documents as JSON lines, 500 to a file; some lack a key."""
    def write(path):
        doc, text = F.col("doc_id"), F.col("text")
        line = F.struct(
            F.when(doc % 10 != 7, doc.cast("string")).alias("custom_id"),
            F.when(doc % 10 == 7, doc.cast("string")).alias("idx"),
            F.when(doc % 10 != 3, text).alias("prompt"),
        )
        (
            d.table(spark, sf_dir, "documents")
            .select("doc_id", F.to_json(line).alias("value"), F.expr("doc_id div 500").alias("file"))
            .repartition("file").sortWithinPartitions("file", "doc_id")
            .select("value", "file").write.partitionBy("file").text(path)
        )

    path = d.written(spark, sf_dir, "unchecked", write)
    return validation.validate_prompts(spark, path).select(
        F.regexp_extract("file_path", "/file=([0-9]+)/", 1).cast("bigint").alias("file"),
        "line_index", F.array_join("keys", ",").alias("keys"),
    )


def validate_rubrics(spark, sf_dir):
    """Every document as a rubric text with some mentions of levels and examples."""
    doc = F.col("doc_id")
    content = F.concat(
        "text", F.repeat(F.lit(" Level 3"), (doc % 8).cast("int")),
        F.repeat(F.lit(" example"), (doc % 9).cast("int")),
    )
    rows = d.table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return validation.validate_rubrics(rows).select("doc_id", "is_valid", "message")


# --- Splitting -----------------------------------------------------------------

def _sizes(spark, sf_dir):
    return splitting.request_sizes(d.prompts(spark, sf_dir), d.rubrics(spark))


def need_split(spark, sf_dir):
    return splitting.need_split(_sizes(spark, sf_dir), MAX_LINES, MAX_BYTES)


def _assigned(spark, sf_dir):
    indexed = positions.with_row_index(d.table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    plan = stored(splitting.split_plan(_sizes(spark, sf_dir), MAX_LINES, MAX_BYTES), "split-plan")
    return splitting.assign_parts(indexed, plan)


def split_plan(spark, sf_dir):
    return _assigned(spark, sf_dir).select("doc_id", "demand", "part", "part_no", "part_row", "part_rows")


def halve_part(spark, sf_dir):
    halves = splitting.halve_part(_assigned(spark, sf_dir))
    return halves.groupBy("part", "half").agg(
        F.count("*").alias("rows"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


# --- Reshaping -----------------------------------------------------------------

def union_outputs(spark, sf_dir):
    base = d.landed(spark, sf_dir)
    frames = [
        output_files.read_outputs(spark, f"{base}/outputs/part={acronym}_part{number}", WRITTEN_GLOB)
        for acronym in d.ACRONYMS for number in (1, 2)
    ]
    return output_files.union_outputs(*frames).select("custom_id", "demand", "part", "finish_reason")


def pivot_wide(spark, sf_dir):
    rows = _long(spark, sf_dir, only_levels=True, keep=("file_pos",))
    return reshape.pivot_wide(rows, F.col("file_pos"), d.ACRONYMS, failures_as="null")


def nest_wide(spark, sf_dir):
    """The nested form, laid out again to be compared."""
    rows = _long(spark, sf_dir, keep=("file_pos",))
    nested = reshape.nest_wide(rows, F.col("file_pos"), d.ACRONYMS, failures_as="null")
    columns = []
    for acronym in d.ACRONYMS:
        cell = F.col("demand")[acronym]
        columns += [
            cell["level"].alias(f"{acronym}_level"), cell["finish_reason"].alias(f"{acronym}_reason"),
            F.md5(cell["model_response"]).alias(f"{acronym}_md5"),
        ]
    return nested.select("custom_id", F.size("demand").alias("demands"), *columns)


def _by_source(spark, sf_dir):
    """Annotations of a source's documents under one id: many per id and demand."""
    rows = _long(spark, sf_dir, keep=("file_pos",))
    sources = d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("custom_id"), "source"
    )
    return rows.join(sources, "custom_id").drop("custom_id").withColumnRenamed("source", "custom_id")


def pivot_wide_last(spark, sf_dir):
    return reshape.pivot_wide(_by_source(spark, sf_dir), F.col("file_pos"), d.ACRONYMS, failures_as="null")


def nest_wide_last(spark, sf_dir):
    nested = reshape.nest_wide(_by_source(spark, sf_dir), F.col("file_pos"), d.ACRONYMS, failures_as="null")
    return reshape.unnest_wide(nested).select(
        "custom_id", "demand", "level", "finish_reason", *_digest("model_response", "response")
    )


# --- Streaming -------------------------------------------------------------------

def stream_status(spark, sf_dir):
    schema = d.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    table = new_scratch(spark, "status")
    columns = ("batch_id", "status", "ts", "event_id")
    status_stream.stream_status(
        d.status_events(events).select(*columns), table, new_scratch(spark, "status-checkpoint")
    ).awaitTermination()
    status_stream.compact_status(spark, table)
    return status_stream.read_status(spark, table).select("batch_id", "status", "event_id")


def stream_pending(spark, sf_dir):
    """Batches that are still to be watched after the stream."""
    return status_stream.pending(stream_status(spark, sf_dir))


def stream_status_tracked(spark, sf_dir):
    """Batches that will finish, watched by a stream that ends when they have."""
    schema = d.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    jobs = d.jobs(spark, sf_dir).filter(F.col("status").isin(*status_stream.FINISHED))
    launched = stored(jobs.select(F.col("id").alias("batch_id")), "launched")
    ours = d.status_events(events).select("batch_id", "status", "ts", "event_id").join(launched, "batch_id", "left_semi")
    table = new_scratch(spark, "tracked")
    query = tracking.track_status(ours, table, new_scratch(spark, "tracked-checkpoint"), launched, interval="1 second")
    query.awaitTermination()
    return tracking.read_tracked(spark, table).select("batch_id", "status", "event_id")


def stream_outputs(spark, sf_dir):
    landing = output_stream.landing_outputs(spark, d.landed(spark, sf_dir), WRITTEN_GLOB, max_files=16)
    path = new_scratch(spark, "stream-annotations")
    output_stream.stream_outputs(
        landing, path, new_scratch(spark, "stream-checkpoint")
    ).awaitTermination()
    return output_stream.read_annotations(spark, path).select(
        "custom_id", "demand", "level", "finish_reason", *_digest("model_response", "response")
    )


def stream_outputs_prompts(spark, sf_dir):
    """Annotations from a stream that takes the prompts from a table by id."""
    landing = output_stream.landing_outputs(spark, d.landed(spark, sf_dir), WRITTEN_GLOB, max_files=16)
    path = new_scratch(spark, "stream-prompted")
    prompts = output_stream.prompts_by_id(
        d.prompts(spark, sf_dir), table_name("prompts"), new_scratch(spark, "prompts-by-id"), _buckets(spark))
    output_stream.stream_outputs(
        landing, path, new_scratch(spark, "stream-checkpoint"), prompts=prompts).awaitTermination()
    return output_stream.read_annotations(spark, path).select(
        "custom_id", "demand", "level", "finish_reason", *_digest("prompt", "prompt"))


def stream_outputs_runs(spark, sf_dir):
    """Annotations of two runs from a stream."""
    landing = output_stream.landing_outputs(spark, d.landed_runs(spark, sf_dir), WRITTEN_GLOB, max_files=16)
    path = new_scratch(spark, "stream-runs")
    output_stream.stream_outputs(
        landing, path, new_scratch(spark, "stream-checkpoint"), only_levels=True, keep=("run",)).awaitTermination()
    return _short_run(output_stream.read_annotations(spark, path)).select("run", "custom_id", "demand", "level")


def _kept_wide(spark, sf_dir):
    """A table of one row per run and id, fed by a stream that was merged once on its way."""
    table = WideTable(spark, new_scratch(spark, "wide"), d.ACRONYMS, _buckets(spark))
    landing = output_stream.landing_outputs(spark, d.landed_runs(spark, sf_dir), WRITTEN_GLOB, max_files=8)
    checkpoint = new_scratch(spark, "wide-checkpoint")
    table.stream(landing, checkpoint, {"once": True}).awaitTermination()
    table.upsert()
    table.stream(landing, checkpoint).awaitTermination()
    return table


def stream_wide(spark, sf_dir):
    return _short_run(_kept_wide(spark, sf_dir).wide(by_run=True, failures_as="null"))


def stream_nested(spark, sf_dir):
    nested = _kept_wide(spark, sf_dir).nested(by_run=True, failures_as="null")
    return reshape.unnest_wide(_short_run(nested)).select(
        "run", "custom_id", "demand", "level", "finish_reason", *_digest("model_response", "response"))


def stream_outputs_broken(spark, sf_dir):
    """Annotations and quarantine of a stream with bad lines: together every line."""
    landing = output_stream.landing_outputs(spark, d.landed_broken(spark, sf_dir), "*.txt*", max_files=16)
    path = new_scratch(spark, "stream-broken")
    output_stream.stream_outputs(landing, path, new_scratch(spark, "stream-checkpoint")).awaitTermination()
    good = output_stream.read_annotations(spark, path).select("custom_id", "demand", "level")
    bad = output_stream.read_quarantine(spark, path).select("custom_id", "demand", F.lit(None).cast("double").alias("level"))
    return good.withColumn("quarantined", F.lit(False)).unionByName(bad.withColumn("quarantined", F.lit(True)))


def stream_summary(spark, sf_dir):
    landing = output_stream.landing_outputs(
        spark, d.landed(spark, sf_dir), WRITTEN_GLOB, max_files=16, content=False
    )
    table = new_scratch(spark, "stream-usage")
    summary_stream.stream_usage(
        landing, table, new_scratch(spark, "usage-checkpoint")
    ).awaitTermination()
    current = summary_stream.read_usage(spark, table).drop("run")
    return _general(usage.batch_summary(d.metadata(spark, sf_dir), current))


# --- The whole ---------------------------------------------------------------------

def annotation_run(spark, sf_dir):
    """Landed files to levels per prompt, with their prompts."""
    run = collect_run(
        spark, d.landed(spark, sf_dir), WRITTEN_GLOB, prompts=d.prompts(spark, sf_dir), only_succeed=True
    )
    return run.long().select("custom_id", "demand", "level", "finish_reason", *_digest("prompt", "prompt"))


def _short_run(rows):
    return rows.withColumn("run", F.regexp_extract("run", "run=([^/]+)$", 1))


def _two_runs(spark, sf_dir):
    return collect_run(spark, d.landed_runs(spark, sf_dir), WRITTEN_GLOB, by_run=True)


def annotate_long_runs(spark, sf_dir):
    """Two runs below one folder whose parts have the same names."""
    return _short_run(_two_runs(spark, sf_dir).long()).select("run", "custom_id", "demand", "level", "finish_reason")


def pivot_wide_runs(spark, sf_dir):
    wide = _short_run(_two_runs(spark, sf_dir).wide(d.ACRONYMS))
    return wide.select("run", "custom_id", *[F.nanvl(name, F.lit(None)).alias(name) for name in d.ACRONYMS])


def _kept(spark, sf_dir):
    """The landed answers and their prompts as tables by id, written once."""
    run = collect_run(spark, d.landed(spark, sf_dir), WRITTEN_GLOB, prompts=d.prompts(spark, sf_dir))
    return run.kept(table_name("kept"), new_scratch(spark, "kept"), _buckets(spark), d.ACRONYMS)


def kept_run_long(spark, sf_dir):
    return _kept(spark, sf_dir).long().select("custom_id", "demand", "level", "finish_reason", *_digest("prompt", "prompt"))


def kept_run_wide(spark, sf_dir):
    wide = _kept(spark, sf_dir).wide()
    return wide.select("custom_id", *[F.nanvl(name, F.lit(None)).alias(name) for name in d.ACRONYMS])


def kept_run_nested(spark, sf_dir):
    nested = reshape.unnest_wide(_kept(spark, sf_dir).nested())
    return nested.select("custom_id", "demand", F.nanvl("level", F.lit(None)).alias("level"), "finish_reason",
                         *_digest("prompt", "prompt"))


QUERIES = {
    query.__name__: query
    for query in (
        read_prompts_jsonl, read_prompts_csv, read_prompts_csv_parallel, read_prompts_parquet, prompts_only, load_rubrics,
        read_outputs, part_inventory, read_errors, read_errors_whole, read_error_details, shape_of_errors, input_tokens_rendered, stream_pending,
        write_requests_bytes, write_requests_exact, batch_summary_runs, general_summary_runs, stream_summary_runs, annotation_summary_broken,
        stream_outputs_broken, read_batch_metadata, job_ledger,
        write_requests, write_annotations_jsonl, write_annotations_csv, write_annotations_parquet,
        split_by_demand, write_annotations_kept,
        render_instruction, build_request, demand_of_path, extract_level, extract_level_guarded,
        annotate_long, bad_rows, annotate_long_broken, annotate_long_drop_file, finish_bucket,
        filter_finish_reason, filter_outcome, filter_outcome_succeed, only_levels, filter_demands,
        filter_demands_prefix, filter_demands_substring, unmatched_prefixes,
        expand_requests, attach_prompts, attach_prompts_hot, prompt_map, price_lookup, jobs_in_ledger,
        completed_jobs, completed_jobs_by_output, missing_outputs, missing_output_parts, unknown_demands,
        annotation_summary, annotation_summary_total, failed_breakdown, batch_usage, batch_usage_files,
        finish_reason_counts, batch_cost, batch_summary, general_summary, general_summary_members,
        pooled_token_stats, status_histogram, batch_progress, token_count, input_tokens_exact,
        input_tokens_approx, estimate_cost, estimate_cost_exact, validate_prompts, validate_rubrics,
        need_split, split_plan, halve_part,
        union_outputs, pivot_wide, nest_wide, pivot_wide_last, nest_wide_last,
        stream_status, stream_status_tracked, stream_outputs, stream_summary,
        stream_outputs_prompts, stream_outputs_runs, stream_wide, stream_nested, annotate_long_runs, pivot_wide_runs,
        kept_run_long, kept_run_wide, kept_run_nested,
        annotation_run,
    )
}
