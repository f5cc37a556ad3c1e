"""Several runs below one folder, names with odd characters, bad lines, odd headers, exact deviations."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from annomill.operators.lookups import attach_prompts, missing_parts
from annomill.operators.requests import expand_requests, request_halves
from annomill.operators.usage import batch_summary, batch_usage, merge_usage, pooled_token_stats, usage_partials
from annomill.plans.runs import collect_run
from annomill.sources.jobs import read_batch_metadata, read_errors
from annomill.sources.outputs import part_inventory, read_outputs
from annomill.sources.prompts import read_prompts
from annomill.sources.rubrics import load_rubrics
from annomill.streaming.outputs import landing_outputs, read_annotations, read_quarantine, stream_outputs


def line(i, tokens, text="x\n\nis 3"):
    body = {"model": "gpt-4o", "choices": [{"finish_reason": "stop", "message": {"content": text}}],
            "usage": {"prompt_tokens": 1, "completion_tokens": tokens}}
    return json.dumps({"custom_id": str(i), "response": {"body": body}}) + "\n"


def land(folder, lines, batch=None):
    folder.mkdir(parents=True)
    (folder / "output.jsonl").write_text("".join(lines))
    if batch:
        (folder / "batch_metadata.json").write_text(json.dumps({
            "id": batch, "status": "completed", "created_at": 1, "completed_at": 2,
            "request_counts": {"total": len(lines), "completed": len(lines), "failed": 0}, "errors": {}}))


def test_runs_are_kept_apart(spark, tmp_path):
    for run, tokens in (("run1", 100), ("run2", 200)):
        land(tmp_path / run / "AA", [line(i, tokens) for i in range(3)], run)
    land(tmp_path / "run2" / "AB", [line(9, 7)], "other")
    run = collect_run(spark, str(tmp_path))
    metadata = read_batch_metadata(spark, str(tmp_path))
    rows = {r.batch_id: r for r in run.batches(metadata).collect()}
    assert {k: (r.finish_total, r.tokens_completion) for k, r in rows.items()} == {
        "run1": (3, 300), "run2": (3, 600), "other": (1, 7)}
    assert rows["run1"].error_file_id is None and rows["run1"].run.endswith("/run1")
    whole = run.overall(metadata).first()
    assert (whole.finish_total, whole.tokens_completion, whole.n_subdomains) == (7, 907, 3)
    with pytest.raises(ValueError, match="runs"):
        batch_summary(metadata.drop("run"), run.usage())
    half = run.outputs.where(F.col("run").endswith("run1"))
    assert [(r.demand, r.part) for r in missing_parts(run.outputs, half).orderBy("part").collect()] == [("AA", "AA"), ("AB", "AB")]


@pytest.mark.parametrize("name", ["A B", "K+X", "Zé", "50%", "a%20b"])
def test_names_are_decoded(name, spark, tmp_path):
    land(tmp_path / "in" / name, [line(1, 2)])
    assert [(r.demand, r.part) for r in read_outputs(spark, str(tmp_path / "in")).collect()] == [(name, name)]
    assert part_inventory(spark, str(tmp_path / "in"), "output.jsonl").first().part == name
    (tmp_path / "rub").mkdir()
    (tmp_path / "rub" / f"{name}.txt").write_text("# Name\n" + "".join(f"Level {k}: text text text\nExample: e\n" for k in range(6)))
    assert [r.acronym for r in load_rubrics(spark, str(tmp_path / "rub")).collect()] == [name]
    path = str(tmp_path / "written")
    read_outputs(spark, str(tmp_path / "in")).select("custom_id", "part").write.partitionBy("part").json(path)
    assert read_outputs(spark, path, "*.json").first().part == name


def test_rubrics_of_the_folder_itself(spark, tmp_path):
    text = "# Name\n" + "".join(f"Level {k}: text text text\nExample: e\n" for k in range(6))
    (tmp_path / "old").mkdir()
    for place in (tmp_path / "AS.txt", tmp_path / "old" / "AS.txt", tmp_path / "old" / "AT.txt"):
        place.write_text(text)
    assert [r.acronym for r in load_rubrics(spark, str(tmp_path)).collect()] == ["AS"]


def test_a_repeated_acronym_is_refused_whatever_the_size(spark):
    twice = spark.createDataFrame([("A", "n", "c"), ("A", "n", "d")], "acronym string, full_name string, content string")
    prompts = spark.createDataFrame([("1", "p")], "custom_id string, prompt string")
    for use in (lambda: request_halves(twice), lambda: expand_requests(prompts, twice)):
        with pytest.raises(ValueError, match="several rubrics are called A"):
            use()


def test_bad_lines_are_shown(spark, tmp_path):
    land(tmp_path / "in" / "AA", [line(1, 2), line(2, 2)[:40] + "\n", line(3, 2)])
    run = collect_run(spark, str(tmp_path / "in"))
    assert run.bad().count() == 1
    total = run.summary().first()
    assert (total.total, total.successful, total.bad) == (2, 2, 1)
    assert run.summary("demand").first().bad == 1
    target = str(tmp_path / "table")
    stream_outputs(landing_outputs(spark, str(tmp_path / "in")), target, str(tmp_path / "cp")).awaitTermination()
    assert read_annotations(spark, target).count() == 2
    kept = read_quarantine(spark, target).collect()
    assert len(kept) == 1 and kept[0].corrupt_record and kept[0].part == "AA" and "output.jsonl" in kept[0].file_path


def test_errors_are_kept_whole(spark, tmp_path):
    folder = tmp_path / "AA"
    folder.mkdir()
    (folder / "errors.jsonl").write_text('{"custom_id":"1","response":{"status_code":400},"error":null}\n{"custom')
    rows = sorted(read_errors(spark, str(tmp_path)).collect(), key=lambda r: r.custom_id or "")
    assert rows[0].corrupt_record == '{"custom' and rows[1].response == '{"status_code":400}' and rows[1].error is None


def test_csv_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("custom_id,prompt\n1,first\n")
    (tmp_path / "b.csv").write_text("prompt,custom_id\nsecond,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_prompts(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "csv").collect()


def test_prompts_never_multiply_annotations(spark):
    rows = spark.createDataFrame([("1", "A", 2.0)], "custom_id string, demand string, level double")
    prompts = spark.createDataFrame([("1", "p"), ("1", "q"), ("2", "r")], "custom_id string, prompt string")
    assert attach_prompts(rows, prompts, F.col("prompt")).collect()[0].prompt == "q"
    with pytest.raises(Exception, match="several prompts for 1"):
        attach_prompts(rows, prompts).collect()


OUTPUT = ("part string, model string, finish_reason string, prompt_tokens long, completion_tokens long, "
          "corrupt_record string, file_path string, file_block long, file_pos long")


def test_deviations_do_not_cancel(spark):
    base = 2_000_000_000
    rows = [("P", "m", "stop", 1, base + i % 2, None, "f", 0, i) for i in range(1001)]
    rows += [("C", "m", "stop", 1, 16_000, None, "f", 0, i) for i in range(1001)]
    found = {r.part: r.std_completion for r in batch_usage(spark.createDataFrame(rows, OUTPUT)).collect()}
    assert found["C"] == 0.0
    assert found["P"] == pytest.approx(statistics.stdev([i % 2 for i in range(1001)]), rel=1e-13)
    many = spark.range(3_000_000).selectExpr(
        "'P' AS part", "'m' AS model", "'stop' AS finish_reason", "1L AS prompt_tokens", "16000L AS completion_tokens",
        "CAST(NULL AS STRING) AS corrupt_record", "'f' AS file_path", "0L AS file_block", "id AS file_pos")
    assert merge_usage(usage_partials(many)).first().std_completion == 0.0


def test_pooled_deviation_is_the_two_pass_one(spark):
    rows = [("b1", 100, 16_000.001, 0.001, 1_600_000), ("b2", 300, 16_000.002, 0.001, 4_800_000)]
    frame = spark.createDataFrame(rows, "subdomain string, requests_total long, tokens_avg_completion double, "
                                        "tokens_std_completion double, tokens_completion long")
    for name in ("tokens_max_completion", "tokens_min_completion"):
        frame = frame.withColumn(name, F.lit(1))
    mean = (100 * 16_000.001 + 300 * 16_000.002) / 400
    squares = sum((n - 1) * s * s + n * (m - mean) ** 2 for _, n, m, s, _ in rows)
    assert pooled_token_stats(frame).first().tokens_std_completion == pytest.approx((squares / 399) ** 0.5, rel=1e-9)
