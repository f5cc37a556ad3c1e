import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from annomill.plans.queries import QUERIES
from annomill.operators.usage import (
    annotation_summary, batch_progress, batch_summary, batch_usage, failed_breakdown, general_summary,
    merge_usage, pooled_token_stats, status_histogram, summary_members, usage_partials,
)

OUTPUT = ("part string, model string, finish_reason string, prompt_tokens long, completion_tokens long, "
          "corrupt_record string, file_path string, file_block long, file_pos long")


@pytest.fixture(scope="module")
def lines():
    rows = []
    for i in range(300):
        part = ("A_part1", "A_part2", "B")[i % 3 if i else 2]
        reason = (None, "stop", "length", "content_filter", "stop")[i % 5]
        rows.append((part, "gpt-4o" if i < 150 else "o4-mini", reason, i, (i * 31) % 211 if i % 17 else None,
                     None, f"f{i % 2}", (i % 4) * 100, i))
    rows.append(("B", None, None, None, None, "{broken", "f9", 0, 999))
    rows.append(("ONE", "gpt-5-mini", "stop", 3, 4, None, "f", 0, 0))
    return rows


@pytest.fixture(scope="module")
def outputs(spark, lines):
    return spark.createDataFrame(lines, OUTPUT).repartition(5)


def test_usage(outputs, lines):
    found = {row["part"]: row for row in batch_usage(outputs).collect()}
    assert set(found) == {"A_part1", "A_part2", "B", "ONE"}
    for part in ("A_part1", "A_part2", "B"):
        mine = [line for line in lines if line[0] == part and line[5] is None]
        tokens = [line[4] or 0 for line in mine]
        row = found[part]
        assert (row["n"], row["prompt_tokens"], row["completion_tokens"]) == (len(mine), sum(l[3] for l in mine), sum(tokens))
        assert row["avg_completion"] == statistics.mean(tokens)
        assert math.isclose(row["std_completion"], statistics.stdev(tokens), rel_tol=1e-12)
        assert (row["max_completion"], row["min_completion"]) == (max(tokens), min(tokens))
        assert row["stop"] == sum(l[2] == "stop" for l in mine) and row["length"] == sum(l[2] == "length" for l in mine)
        assert row["other"] == len(mine) - row["stop"] - row["length"]
        assert row["model"] == max(mine, key=lambda l: l[6:])[1]
    assert found["ONE"]["std_completion"] is None


def test_partial_sums_merge_in_any_grouping(outputs, as_rows):
    halves = [usage_partials(outputs.filter(F.col("file_pos") % 2 == k)) for k in (0, 1)]
    assert as_rows(merge_usage(halves[0].unionByName(halves[1]))) == as_rows(batch_usage(outputs))


METADATA = ("id string, status string, created_at long, completed_at long, output_file_id string, error_file_id string, "
            "request_counts struct<total:long,completed:long,failed:long>, errors string, part string")


@pytest.fixture(scope="module")
def metadata(spark, lines):
    n = {part: sum(l[0] == part and l[5] is None for l in lines) for part in ("A_part1", "A_part2", "B", "ONE")}
    return spark.createDataFrame([
        ("b1", "completed", 100, 160, "o", None, (n["A_part1"], n["A_part1"], 0), None, "A_part1"),
        ("b2", "completed", 100, 190, "o", "e", (n["A_part2"], n["A_part2"] - 1, 1), "bad", "A_part2"),
        ("b3", "failed", 100, 130, "o", "e", (n["B"], n["B"], 0), None, "B"),
        ("b4", "in_progress", 100, None, "o", None, (n["ONE"], 1, 0), None, "ONE"),
        ("b5", "cancelled", 100, 101, None, None, (0, 0, 0), None, "NOOUT"),
    ], METADATA)


@pytest.fixture(scope="module")
def summaries(metadata, outputs):
    return batch_summary(metadata, batch_usage(outputs))


def test_batch_summary(summaries):
    rows = {row["batch_id"]: row for row in summaries.collect()}
    assert rows["b1"]["duration"] == 60 and rows["b1"]["completed_at"] == "1970-01-01T00:02:40"
    assert rows["b4"]["duration"] is None and rows["b4"]["completed_at"] is None
    # First key contained in the name: gpt-5 for gpt-5-mini.
    assert rows["b4"]["cost_total"] == 3 / 1e6 * 0.625 + 4 / 1e6 * 5.0
    assert (rows["b2"]["errors"], rows["b2"]["error_file_id"], rows["b3"]["error_file_id"]) == ("bad", "e", None)
    none = rows["b5"]
    assert (none["finish_total"], none["tokens_total"], none["cost_total"], none["model"]) == (0, 0, 0.0, None)


def test_pooled_statistics_are_those_of_all_lines(summaries, lines):
    pooled = pooled_token_stats(summaries).first()
    tokens = [line[4] or 0 for line in lines if line[5] is None]
    assert pooled["tokens_completion"] == sum(tokens)
    assert math.isclose(pooled["tokens_avg_completion"], statistics.mean(tokens), rel_tol=1e-12)
    assert math.isclose(pooled["tokens_std_completion"], statistics.stdev(tokens), rel_tol=1e-12)
    assert (pooled["tokens_max_completion"], pooled["tokens_min_completion"]) == (max(tokens), 0)


def test_pooled_statistics_of_large_and_close_means(spark):
    """Means far from zero and close together, where sums of squares of doubles would cancel."""
    rng = random.Random(2)
    batches = [(rng.randrange(1, 50_000), 1e6 + rng.random() / 1000, rng.random()) for _ in range(200)] + [(3, None, None)]
    frame = spark.createDataFrame([(n, m, s, 7, 9, 1) for n, m, s in batches],
                                  "requests_total long, tokens_avg_completion double, tokens_std_completion double, "
                                  "tokens_completion long, tokens_max_completion long, tokens_min_completion long")
    for some in (batches[:-1], batches):
        total = sum(n for n, _, _ in some)
        exact = [(n, Fraction(m or 0), Fraction(s or 0)) for n, m, s in some]
        mean = sum(n * m for n, m, _ in exact) / total
        squares = sum((n - 1) * s * s + n * (m - mean) ** 2 for n, m, s in exact)
        row = pooled_token_stats(frame.where("tokens_avg_completion IS NOT NULL") if len(some) == 200 else frame).first()
        assert math.isclose(row.tokens_avg_completion, mean, rel_tol=1e-14)
        assert math.isclose(row.tokens_std_completion, math.sqrt(squares / (total - 1)), rel_tol=1e-9)


def test_one_pass_over_what_the_summaries_are_made_of(spark, sf_dir):
    for name in ("general_summary", "pooled_token_stats"):
        frame = QUERIES[name](spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        # One scan for the usage and one for the derived metadata.
        assert plan.count("\nLocation:") == 2 and "Subquery" not in plan, name


def test_pooled_without_tokens(summaries):
    pooled = pooled_token_stats(summaries.filter("batch_id = 'b5'")).first()
    assert tuple(pooled) == (0, 0.0, 0.0, 0, 0)


def test_general_summary(summaries):
    row = general_summary(summaries).first()
    assert row["batches"] == 5 and row["n_subdomains"] == 5
    assert row["demands"] == ["A", "B", "NOOUT", "ONE"]
    assert row["models"] == ["gpt-5-mini", "o4-mini"]
    assert (row["status_completed"], row["status_failed"], row["status_others"]) == (2, 1, 2)
    assert row["duration_mean"] == statistics.mean([60, 90, 30, 1])
    assert math.isclose(row["duration_std"], statistics.stdev([60, 90, 30, 1]))
    assert row["finish_total"] == 301 == row["requests_total"]
    members = {(m["kind"], m["name"]): m["batches"] for m in summary_members(summaries).collect()}
    assert members[("model", "o4-mini")] == 3 and members[("subdomain", "B")] == 1


def test_annotation_summary(spark, as_rows):
    long = spark.createDataFrame(
        [("X", 1.0, "stop"), ("X", None, "stop"), ("X", None, "length"), ("Y", 0.0, "stop")],
        "demand string, level double, finish_reason string")
    assert as_rows(annotation_summary(long)) == [(4, 2, 50.0, 2, 50.0)]
    assert as_rows(annotation_summary(long, "demand"), "demand", "total", "failed_percent") == [
        ("X", 3, 100 * 2 / 3), ("Y", 1, 0.0)]
    assert as_rows(failed_breakdown(long)) == [("length", 1, 50.0), ("stop", 1, 50.0)]
    with pytest.raises(Exception, match="no annotations"):
        annotation_summary(long.limit(0)).collect()


def test_jobs(spark, as_rows):
    jobs = spark.createDataFrame(
        [("a", "in_progress", (4, 1)), ("b", "in_progress", (0, 0)), ("c", None, (1, 1)), ("d", "completed", (1, 1))],
        "id string, status string, request_counts struct<total:long,completed:long>")
    assert as_rows(status_histogram(jobs)) == [("completed", 1, 25.0), ("error", 1, 25.0), ("in_progress", 2, 50.0)]
    assert as_rows(batch_progress(jobs)) == [("a", 1, 4, 25.0), ("b", 0, 0, None)]
