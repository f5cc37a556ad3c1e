import json

import pytest
from pyspark.sql import functions as F

from annomill.operators.annotate import annotate_long, bad_rows, good_rows, nan_levels
from annomill.operators.lookups import unknown_demands
from annomill.operators.requests import filter_demands, filter_demands_prefix, unmatched_prefixes
from annomill.operators.validation import prompts_ok, validate_prompts
from annomill.plans.derived import rubric_text
from annomill.plans.runs import collect_run
from annomill.sinks.annotations import write_annotations
from annomill.sources.jobs import (
    launched_demands, read_batch_metadata, read_error_details, read_errors, read_job_ledger, shape_of_errors,
    write_job_ledger,
)
from annomill.sources.outputs import line_order, part_inventory, read_outputs, union_outputs
from annomill.sources.prompts import prompt_map, prompts_only, read_prompts
from annomill.sources.rubrics import load_rubrics, parse_rubrics, read_rubric_files

TRICKY = [
    ("1", 'line one\nline "two"'), ("2", "Straße ∑ 中文"), ("03", " padded, with comma "), ("4", "back\\slash"),
]


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records), "utf-8")
    return str(path)


def answer(custom_id, content="x\n\nis: 2", finish="stop", model="gpt-4o", usage=(5, 7)):
    body = {"model": model, "choices": [{"finish_reason": finish, "message": {"content": content}}]}
    if usage:
        body["usage"] = {"prompt_tokens": usage[0], "completion_tokens": usage[1]}
    return {"custom_id": custom_id, "response": {"body": body}}


# --- Prompts -------------------------------------------------------------------

def test_prompts_keep_their_text(spark, tmp_path, as_rows):
    jsonl = write_lines(tmp_path / "p.jsonl", [{"custom_id": i, "prompt": p, "more": 1} for i, p in TRICKY])
    assert as_rows(read_prompts(spark, jsonl)) == sorted(TRICKY)
    csv = tmp_path / "p.csv"
    quoted = "".join('x,"{}","{}"\n'.format(p.replace('"', '""'), i) for i, p in TRICKY)
    csv.write_text("more,prompt,custom_id\n" + quoted, "utf-8")
    assert as_rows(read_prompts(spark, str(csv), "csv")) == sorted(TRICKY)
    parquet = str(tmp_path / "p.parquet")
    spark.createDataFrame([(int(i), p) for i, p in TRICKY if i != "03"], "custom_id int, prompt string").write.parquet(parquet)
    assert as_rows(read_prompts(spark, parquet, "parquet"), "custom_id") == [("1",), ("2",), ("4",)]
    assert as_rows(prompts_only(spark, jsonl)) == sorted((p,) for _, p in TRICKY)


def test_bad_prompts(spark, tmp_path, as_rows):
    path = write_lines(tmp_path / "p.jsonl", [
        {"custom_id": "a", "prompt": "x"}, {"custom_id": "b"}, {"prompt": "y", "idx": 3}, "{broken", {"custom_id": "c", "prompt": "z"},
    ])
    with pytest.raises(Exception, match="lacks"):
        read_prompts(spark, path).collect()
    kept = read_prompts(spark, path, mode="quarantine")
    assert as_rows(kept) == [("a", "x"), ("c", "z")]
    found = validate_prompts(spark, path)
    assert not prompts_ok(found)
    assert as_rows(found, "line_index", "keys") == [(1, ["custom_id"]), (2, ["prompt", "idx"]), (3, [])]
    with pytest.raises(ValueError):
        read_prompts(spark, path, mode="lax")
    with pytest.raises(ValueError):
        read_prompts(spark, path, "xml")


def test_missing_column(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("id,prompt\n1,x\n")
    with pytest.raises(KeyError):
        read_prompts(spark, str(path), "csv")


def test_line_index_over_many_splits(spark, tmp_path, as_rows):
    bad = {}
    for name in ("one", "two"):
        records, bad[name] = [], []
        for i in range(3000):
            record = {"custom_id": str(i), "prompt": "p" * (i % 37)}
            if i % 13 == 5:
                del record["prompt"]
                bad[name].append(i)
            records.append(record)
        write_lines(tmp_path / f"{name}.jsonl", records)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "512")
    try:
        found = validate_prompts(spark, str(tmp_path)).select(
            F.regexp_extract("file_path", r"(\w+)\.jsonl", 1).alias("file"), "line_index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name in bad:
        assert sorted(row["line_index"] for row in found if row["file"] == name) == bad[name]


def test_prompt_map_takes_the_last(spark, as_rows):
    frame = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "one", 0)], "custom_id string, prompt string, ord int")
    assert as_rows(prompt_map(frame, F.col("ord"))) == [("a", "new"), ("b", "one")]


# --- Rubrics -------------------------------------------------------------------

def test_rubric_files(spark, tmp_path):
    text = rubric_text("Care")
    files = {
        "LF": f"# Care and Thought \n{text}\n",
        "CR": f"#  Care\r\n{text}\n".replace("\n", "\r\n").replace("\r\r", "\r"),
        "NOHASH": f"Care\n{text}",
        "ONELINE": "# Care",
        "ENDLINE": "# Care\n",
        "NONAME": f"\n{text}",
        "EMPTY": "",
        "BLANK": "# Care\n\n  \n",
        "LEVELS": "# Care\n" + text.replace("Level 5", "Step 5"),
        "SHORT": "# Care\n" + "Level 1 " * 6 + "example " * 6,
        "NOEX": "# Care\n" + text.replace("Examples", "Cases"),
        "FEWEX": "# Care\n" + text.replace("Examples", "Cases", 1),
    }
    for name, content in files.items():
        (tmp_path / f"{name}.txt").write_bytes(content.encode())
    (tmp_path / "notes.md").write_text("# not a rubric")
    loaded = {row["acronym"]: row for row in load_rubrics(spark, str(tmp_path)).collect()}
    assert set(loaded) == {"LF", "CR"}
    assert loaded["LF"]["full_name"] == "Care and Thought" and loaded["CR"]["full_name"] == "Care"
    assert loaded["LF"]["content"] == loaded["CR"]["content"] == text
    messages = {row["acronym"]: row["message"] for row in read_rubric_files(spark, str(tmp_path)).collect()}
    assert messages["NOHASH"] == "First line must contain full name starting with '#'"
    assert messages["ONELINE"] == messages["ENDLINE"] == "Missing rubric content"
    assert messages["NONAME"] == "Missing full name on first line"
    # Spark lists no empty files.
    assert "EMPTY" not in messages
    empty = spark.createDataFrame([("E", "E.txt", "")], "acronym string, file_path string, value string")
    assert parse_rubrics(empty).first()["message"] == "Empty rubric file"
    assert messages["BLANK"] == "Empty rubric content"
    assert messages["LEVELS"].startswith("Rubric should contain, at least, all level")
    assert messages["SHORT"] == "Rubric content seems too short"
    assert messages["NOEX"] == "Rubric should contain examples for each level"
    assert messages["FEWEX"].startswith("Rubric should contain at least one example")
    rubrics = load_rubrics(spark, str(tmp_path))
    assert filter_demands(rubrics, "LF").count() == 1
    with pytest.raises(ValueError):
        filter_demands(rubrics, ["L"])
    assert [row["name"] for row in unknown_demands(["LF", "ZZ"], rubrics).collect()] == ["ZZ"]


# --- Outputs -------------------------------------------------------------------

@pytest.fixture()
def run_folder(tmp_path):
    base = tmp_path / "run"
    write_lines(base / "AA_part1" / "output.jsonl", [
        answer("1"), answer("2", "no level", "stop"), answer("3", "cut 4", "length"), answer("1", "x\n\nis: 5", model="o1"),
    ])
    write_lines(base / "AA_part2" / "output.jsonl", [answer("4", finish="content_filter"), answer("5", finish=None)])
    write_lines(base / "AB" / "output.jsonl", [
        answer("1", "is 1"), "{broken", answer("2", None), {"custom_id": "3", "response": {"body": {"choices": []}}},
        answer("6", None, "content_filter", usage=None),
    ])
    write_lines(base / "AB" / "errors.jsonl", [{"custom_id": "9", "error": {"code": "x", "n": 1}}])
    for folder in ("AA_part1", "AA_part2", "AB", "CD"):
        write_lines(base / folder / "input.jsonl", [{"custom_id": str(i)} for i in range(3)])
    write_lines(base / "AB" / "batch_metadata.json", [json.dumps({
        "id": "b1", "status": "completed", "created_at": 10, "completed_at": 70, "output_file_id": "o",
        "error_file_id": "e", "request_counts": {"total": 5, "completed": 4, "failed": 1}, "errors": None,
    }, indent=2)])
    return base


def test_outputs_from_folders(spark, run_folder, as_rows):
    outputs = read_outputs(spark, str(run_folder))
    assert outputs.count() == 11
    assert as_rows(outputs.select("demand", "part").distinct()) == [
        ("AA", "AA_part1"), ("AA", "AA_part2"), ("AB", "AB")]
    long = annotate_long(outputs)
    found = as_rows(long, "custom_id", "demand", "level", "finish_reason")
    assert found == sorted([
        ("1", "AA", 2.0, "stop"), ("2", "AA", None, "stop"), ("3", "AA", None, "length"), ("1", "AA", 5.0, "stop"),
        ("4", "AA", None, "content_filter"), ("5", "AA", None, None), ("1", "AB", 1.0, "stop"),
        ("6", "AB", None, "content_filter"),
    ], key=repr)
    assert nan_levels(long).filter(F.isnan("level")).count() == 5


def test_bad_output_rows(spark, run_folder, as_rows):
    outputs = read_outputs(spark, str(run_folder))
    assert as_rows(bad_rows(outputs), "demand", "custom_id") == [("AB", "2"), ("AB", "3"), ("AB", None)]
    dropped = annotate_long(outputs, on_bad_row="drop_file")
    assert as_rows(dropped.select("demand").distinct()) == [("AA",)]
    assert dropped.count() == 6
    with pytest.raises(ValueError):
        good_rows(outputs, "ignore")


def test_filters(spark, run_folder, as_rows):
    outputs = read_outputs(spark, str(run_folder))
    assert annotate_long(outputs, finish_reason="other").count() == 3
    assert annotate_long(outputs, finish_reason="length").count() == 1
    assert annotate_long(outputs, only_succeed=True).count() == 3
    assert annotate_long(outputs, only_failed=True, finish_reason="stop", only_levels=True).columns == [
        "custom_id", "demand", "level"]
    with pytest.raises(ValueError):
        annotate_long(outputs, only_failed=True, only_succeed=True)
    with pytest.raises(ValueError):
        annotate_long(outputs, finish_reason="filtered")


def test_lines_are_in_file_order(spark, run_folder):
    outputs = read_outputs(spark, str(run_folder)).withColumn("order", line_order())
    order = [(row["part"], row["custom_id"]) for row in outputs.sort("order").collect()]
    assert order == [
        ("AA_part1", "1"), ("AA_part1", "2"), ("AA_part1", "3"), ("AA_part1", "1"),
        ("AA_part2", "4"), ("AA_part2", "5"), ("AB", "1"), ("AB", None), ("AB", "2"), ("AB", "3"), ("AB", "6")]


def test_beside_the_outputs(spark, run_folder, as_rows):
    inventory = part_inventory(spark, str(run_folder))
    assert as_rows(inventory.filter("kind = 'input'"), "part", "rows", "bytes") == [
        (part, 3, 57) for part in ("AA_part1", "AA_part2", "AB", "CD")]
    assert as_rows(inventory.filter("kind = 'output'"), "part", "rows") == [("AA_part1", 4), ("AA_part2", 2), ("AB", 5)]
    errors = read_errors(spark, str(run_folder))
    assert errors.columns == ["run", "demand", "part", "custom_id", "error", "response", "corrupt_record"]
    assert as_rows(errors.drop("run")) == [("AB", "AB", "9", '{"code": "x", "n": 1}', None, None)]
    metadata = read_batch_metadata(spark, str(run_folder)).collect()
    assert [(m["demand"], m["id"], m["request_counts"]["failed"]) for m in metadata] == [("AB", "b1", 1)]


def test_errors_of_any_shape(spark, tmp_path):
    part = tmp_path / "run" / "AB_part2"
    part.mkdir(parents=True)
    lines = [
        {"custom_id": "1", "error": {"code": "x", "message": "m", "more": [1]}},
        {"custom_id": "2", "error": None, "response": {"status_code": 429, "body": {"error": {"type": "rate", "message": "slow"}}}},
        {"custom_id": "3", "error": "plain text"},
        {"custom_id": 4, "error": {"code": 17, "message": {"deep": 1}}, "status_code": "500"},
        {"custom_id": "5", "response": {"status_code": "many"}},
        {},
    ]
    (part / "errors.jsonl").write_text("\n".join([*map(json.dumps, lines), '{"custom_id": "6", ', "[1, 2]", '"text"', "", "null"]))
    rows = read_error_details(spark, str(tmp_path / "run")).collect()
    assert {r.custom_id: (r.status_code, r.code, r.message) for r in rows if r.custom_id} == {
        "1": (None, "x", "m"), "2": (429, "rate", "slow"), "3": (None, None, "plain text"),
        "4": (500, "17", '{"deep":1}'), "5": (None, None, None)}
    assert sorted(r.corrupt_record for r in rows if r.corrupt_record) == ['"text"', "[1, 2]", "null", '{"custom_id": "6", ']
    assert {(r.demand, r.part) for r in rows} == {("AB", "AB_part2")} and len(rows) == 10
    assert [json.loads(r.details.toJson()) for r in rows if r.custom_id == "1"] == lines[:1]
    shape = shape_of_errors(read_error_details(spark, str(tmp_path / "run"))).first().shape
    assert shape.startswith("OBJECT<custom_id: VARIANT, error: VARIANT, response: OBJECT<body: OBJECT<error")


def test_ledger(spark, tmp_path, as_rows):
    path = tmp_path / "ids.json"
    path.write_text(json.dumps({"/runs/AA_part1": "b1", "/runs/AB": "b2"}, indent=1))
    ledger = read_job_ledger(spark, str(path), "map")
    assert as_rows(ledger) == [("AA", "AA_part1", "b1"), ("AB", "AB", "b2")]
    write_job_ledger(ledger, str(tmp_path / "table"))
    again = read_job_ledger(spark, str(tmp_path / "table"))
    assert as_rows(again) == as_rows(ledger)
    assert as_rows(launched_demands(again)) == [("AA", "AA_part1"), ("AB", "AB")]


def test_prefixes_that_match_nothing(spark, run_folder):
    outputs = read_outputs(spark, str(run_folder))
    assert [row["name"] for row in unmatched_prefixes(outputs, ["A", "AB_part", "AA_part2"]).collect()] == ["AB_part"]
    assert [row["name"] for row in unmatched_prefixes(outputs, ["part2", "C"], anywhere=True).collect()] == ["C"]
    assert filter_demands_prefix(outputs, ["AA"]).count() == 6
    assert filter_demands_prefix(outputs, ["part2", "AB"], anywhere=True).count() == 7


def test_union(spark, run_folder):
    one = read_outputs(spark, str(run_folder / "AA_part1"))
    two = read_outputs(spark, str(run_folder / "AA_part2"))
    assert union_outputs(one, two).count() == 6
    with pytest.raises(ValueError):
        union_outputs()


def test_run_with_filters(spark, run_folder, tmp_path, as_rows):
    """Prompts whose answer was cut short, to be tried again."""
    path = write_lines(tmp_path / "p.jsonl", [{"custom_id": "3", "prompt": p} for p in ("old", "new")])
    run = collect_run(spark, str(run_folder), prompts=read_prompts(spark, path, position=True),
                      only_failed=True, finish_reason="length", only_levels=True)
    write_annotations(nan_levels(run.long()), str(tmp_path / "out"), split_by_demand=True)
    lines = [json.loads(line) for f in (tmp_path / "out" / "demand=AA").glob("*.json") for line in open(f)]
    assert lines == [{"custom_id": "3", "level": "NaN", "prompt": "new"}]
    assert as_rows(run.summary(), "total", "successful", "successful_percent", "failed", "failed_percent") == [(1, 0, 0.0, 1, 100.0)]
    assert run.summary().first()["bad"] == run.bad().count()
    assert as_rows(run.failures()) == [("length", 1, 100.0)]


def test_run(spark, run_folder, as_rows):
    prompts = spark.createDataFrame([("1", "one"), ("4", "four")], "custom_id string, prompt string")
    run = collect_run(spark, str(run_folder), prompts=prompts)
    assert as_rows(run.long().filter("custom_id in ('1', '2')"), "demand", "custom_id", "prompt") == [
        ("AA", "1", "one"), ("AA", "1", "one"), ("AA", "2", ""), ("AB", "1", "one")]
    wide = {row["custom_id"]: (row["AA"], row["AB"]) for row in run.wide().collect()}
    # The later line for id 1 replaced the earlier one.
    assert wide["1"] == (5.0, 1.0)
    nested = {row["custom_id"]: row for row in run.nested().collect()}
    assert nested["1"]["demand"]["AA"]["level"] == 5.0 and nested["1"]["prompt"] == "one"
    assert set(nested["6"]["demand"]) == {"AB"} and nested["6"]["prompt"] == ""
    assert as_rows(run.summary("demand"), "demand", "total", "failed") == [("AA", 6, 4), ("AB", 2, 1)]
    usage = {row["part"]: row for row in run.usage().collect()}
    assert usage["AA_part1"]["model"] == "o1" and usage["AA_part1"]["n"] == 4
    # Lines that are JSON count, whatever they hold; missing usage counts as zero.
    assert (usage["AB"]["n"], usage["AB"]["completion_tokens"], usage["AB"]["min_completion"]) == (4, 14, 0)
    assert (usage["AB"]["stop"], usage["AB"]["length"], usage["AB"]["other"]) == (2, 0, 2)
    batch = run.batches(read_batch_metadata(spark, str(run_folder))).first()
    assert (batch["duration"], batch["created_at"], batch["requests_failed"]) == (60, "1970-01-01T00:00:10", 1)
    overall = run.overall(read_batch_metadata(spark, str(run_folder))).first()
    assert overall["batches"] == 1 and overall["duration_std"] == 0.0 and overall["models"] == ["gpt-4o"]
