import json
import random

import pytest
from pyspark.sql import functions as F

from annomill.fixed_values import INSTRUCTION_TEMPLATE
from annomill.operators.positions import with_file_index, with_row_index
from annomill.operators.requests import build_requests, expand_requests, pair_with, render_requests
from annomill.operators.splitting import (
    assign_parts, deal_exactly, exact_cuts, halve_part, need_split, request_sizes, split_plan,
)
from annomill.plans.derived import rubric_text
from annomill.plans.runs import create_requests
from annomill.sinks.requests import write_requests
from annomill.sources.prompts import read_prompts

PROMPTS = [("a", "plain"), ("b", 'say "hi"\n\\ \t'), ("c", "中文 ∑ é"), ("d", "\u0001 control")]


@pytest.fixture(scope="module")
def prompts(spark):
    return spark.createDataFrame(PROMPTS, "custom_id string, prompt string")


@pytest.fixture(scope="module")
def rubrics(spark):
    rows = [(a, name, rubric_text(name)) for a, name in (("AA", "Alpha"), ("B_x", "Beta"), ("C", "Gamma"))]
    return spark.createDataFrame(rows, "acronym string, full_name string, content string")


def test_rendered_text(prompts, rubrics):
    texts = {(r["custom_id"], r["demand"]): r["instruction"] for r in render_requests(prompts, rubrics).collect()}
    assert len(texts) == 12
    for (custom_id, demand), text in texts.items():
        name = {"AA": "Alpha", "B_x": "Beta", "C": "Gamma"}[demand]
        assert text == INSTRUCTION_TEMPLATE.format(name=name, rubric=rubric_text(name), prompt=dict(PROMPTS)[custom_id])
        assert text.count(f"*{name}*") == 4


def test_request_line(prompts, rubrics):
    row = build_requests(prompts, rubrics, "m", 7, "/v1").filter("custom_id = 'a' and demand = 'C'")
    line = json.loads(row.select(F.to_json(F.struct("custom_id", "method", "url", "body"))).first()[0])
    assert list(line) == ["custom_id", "method", "url", "body"]
    assert line["method"] == "POST" and line["url"] == "/v1"
    body = line["body"]
    assert list(body) == ["model", "messages", "max_tokens", "temperature"]
    assert (body["model"], body["max_tokens"], body["temperature"]) == ("m", 7, 0)
    assert body["messages"][0] == {"role": "system", "content": ""}
    assert body["messages"][1]["role"] == "user" and "TASK INSTANCE: plain\n" in body["messages"][1]["content"]


def test_sizes_are_those_of_the_written_lines(prompts, rubrics, as_rows):
    line = F.to_json(F.struct("custom_id", "method", "url", "body"))
    written = build_requests(prompts, rubrics).groupBy("demand").agg(
        F.count("*").alias("n_lines"), F.sum(F.octet_length(line) + 1).alias("n_bytes"))
    assert as_rows(request_sizes(prompts, rubrics)) == as_rows(written)


def test_sizes_of_nothing(prompts, rubrics):
    sizes = request_sizes(prompts.limit(0), rubrics)
    assert {(r["n_lines"], r["n_bytes"]) for r in sizes.collect()} == {(0, 0)}
    assert not split_plan(sizes, 5, 100).filter("need_split").count()


SPLITS = [
    # lines, bytes, max_lines, max_bytes, sizes of the parts
    (10, 10, 4, None, [4, 3, 3]),
    (10, 1000, None, 300, [3, 3, 2, 2]),
    (10, 1000, 2, 600, [2, 2, 2, 2, 2]),
    (10, 100, 10, 100, [10]),
    (2, 1000, None, 300, [1, 1]),
    (7, 700, 3, 400, [3, 2, 2]),
]


@pytest.mark.parametrize("lines, size, max_lines, max_bytes, parts", SPLITS)
def test_split_vectors(spark, lines, size, max_lines, max_bytes, parts):
    sizes = spark.createDataFrame([("X", lines, size)], "demand string, n_lines long, n_bytes long")
    plan = split_plan(sizes, max_lines, max_bytes)
    indexed = spark.range(lines).select(F.col("id").alias("row_index"), F.lit(lines).cast("bigint").alias("n_rows"))
    rows = assign_parts(indexed, plan).sort("row_index").collect()
    dealt = {}
    for row in rows:
        dealt.setdefault((row["part_no"], row["part"]), []).append(row)
    names = ["X"] if len(parts) == 1 else [f"X_part{i + 1}" for i in range(len(parts))]
    assert list(dealt) == [(i + 1, name) for i, name in enumerate(names)]
    assert [len(part) for part in dealt.values()] == parts
    for part in dealt.values():
        assert [row["part_row"] for row in part] == list(range(len(part)))
        assert {row["part_rows"] for row in part} == {len(part)}
        indexes = [row["row_index"] for row in part]
        assert indexes == list(range(indexes[0], indexes[0] + len(part)))


def test_limits(spark):
    sizes = spark.createDataFrame([("X", 10, 100)], "demand string, n_lines long, n_bytes long")
    for limits, needed in [((10, 100), False), ((9, None), True), ((None, 99), True), ((None, None), False)]:
        assert need_split(sizes, *limits).first()["need_split"] is needed
    with pytest.raises(ValueError):
        split_plan(sizes, None, None)


def test_dealing_is_ntile_for_any_sizes(spark):
    random.seed(3)
    cases = [(random.randint(1, 60), random.randint(1, 25)) for _ in range(60)]
    sizes = spark.createDataFrame(
        [(f"{n}:{p}:{i}", n, p * 10) for i, (n, p) in enumerate(cases)], "demand string, n_lines long, n_bytes long")
    plan = split_plan(sizes, None, 10)
    for n in sorted({n for n, _ in cases}):
        indexed = spark.range(n).select(F.col("id").alias("row_index"), F.lit(n).cast("bigint").alias("n_rows"))
        rows = assign_parts(indexed, plan.filter(F.col("n_lines") == n)).collect()
        for demand in {row["demand"] for row in rows}:
            p = int(demand.split(":")[1])
            numbers = [r["part_no"] for r in sorted(rows, key=lambda r: r["row_index"]) if r["demand"] == demand]
            expected = [k + 1 for k in range(p) for _ in range(n // p + (k < n % p))]
            assert numbers == expected


def test_halves(spark):
    frame = spark.range(7).select(F.col("id").alias("part_row"), F.lit(7).alias("part_rows"))
    assert [r["half"] for r in halve_part(frame).sort("part_row").collect()] == [1, 1, 1, 2, 2, 2, 2]


def test_row_index_spreads_one_hot_key(spark):
    frame = spark.range(0, 4000, 1, 5).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    indexed = with_row_index(frame, ["k"])
    rows = indexed.sort("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(4000))
    assert {r["n_rows"] for r in rows} == {4000}
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_file_index_is_the_order_of_the_lines(spark, tmp_path):
    expected = []
    for name in ("a", "b", "c"):
        with open(tmp_path / f"{name}.jsonl", "w") as f:
            for i in range(700):
                f.write(json.dumps({"custom_id": f"{name}{i}", "prompt": "x" * (i % 91)}) + "\n")
                if i % 50 == 7:
                    f.write("\n")  # Spark skips empty lines.
                expected.append(f"{name}{i}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        rows = with_file_index(read_prompts(spark, str(tmp_path), position=True)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows.sort(key=lambda r: r["row_index"])
    assert [r["custom_id"] for r in rows] == expected
    assert [r["row_index"] for r in rows] == list(range(2100)) and rows[0]["n_rows"] == 2100


def test_file_index_needs_all_rows(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text("".join(f'{{"custom_id": "{i}", "prompt": "x"}}\n' for i in range(9)))
    prompts = read_prompts(spark, str(tmp_path), position=True)
    with pytest.raises(Exception, match="rows are missing"):
        with_file_index(prompts.filter("custom_id != '4'"))
    assert with_row_index(prompts.filter("custom_id != '4'"), ["custom_id"]).agg(F.max("row_index")).first()[0] == 7


def test_file_index_over_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name, count in (("a", 5000), ("b", 10), ("c", 3000)):
        table = pa.table({"custom_id": [f"{name}{i}" for i in range(count)], "prompt": ["x" * (i % 50) for i in range(count)]})
        pq.write_table(table, tmp_path / f"{name}.parquet", row_group_size=200, compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        prompts = read_prompts(spark, str(tmp_path), "parquet", position=True)
        assert prompts.select("file_path", "file_block").distinct().count() > 5
        rows = with_file_index(prompts).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows.sort(key=lambda r: r["row_index"])
    assert [r["custom_id"] for r in rows] == [f"{n}{i}" for n, c in (("a", 5000), ("b", 10), ("c", 3000)) for i in range(c)]
    assert [r["row_index"] for r in rows] == list(range(8010))


def read_parts(folder):
    """Lines of every part; a part must be one file."""
    parts = {}
    for path in sorted(folder.glob("demand=*/part=*")):
        files = list(path.glob("*.json"))
        assert len(files) == 1
        parts[path.name.removeprefix("part=")] = [json.loads(line) for line in open(files[0], encoding="utf-8")]
    return parts


def test_written_parts(spark, tmp_path, rubrics):
    source = tmp_path / "prompts.jsonl"
    ids = [f"id{i}" for i in range(25)]
    random.seed(5)
    random.shuffle(ids)
    source.write_text("".join(json.dumps({"custom_id": i, "prompt": f"do {i}"}) + "\n" for i in ids))
    folder = tmp_path / "rubrics"
    folder.mkdir()
    for row in rubrics.collect():
        (folder / f"{row['acronym']}.txt").write_text(f"# {row['full_name']}\n{row['content']}")
    create_requests(spark, str(source), str(folder), str(tmp_path / "out"), ["AA", "C"], max_lines=10, max_bytes=None)
    parts = read_parts(tmp_path / "out")
    assert {name: len(lines) for name, lines in parts.items()} == {
        f"{d}_part{i}": n for d in ("AA", "C") for i, n in ((1, 9), (2, 8), (3, 8))}
    # Parts hold the prompts in the order of their file.
    assert [l["custom_id"] for i in (1, 2, 3) for l in parts[f"C_part{i}"]] == ids
    assert "*Gamma*" in parts["C_part2"][0]["body"]["messages"][1]["content"]


def test_unlimited_parts(spark, tmp_path, prompts, rubrics):
    write_requests(prompts, rubrics, str(tmp_path / "out"), max_lines=None, max_bytes=None)
    lines = [json.loads(l) for f in (tmp_path / "out").glob("demand=C/part=C/*.json") for l in open(f, encoding="utf-8")]
    assert sorted(l["custom_id"] for l in lines) == ["a", "b", "c", "d"]


def test_too_many_rubrics_for_memory(spark, tmp_path, prompts, rubrics, monkeypatch, as_rows):
    expected = as_rows(expand_requests(prompts, rubrics))
    for limit in (200, 1000):  # Bytes; the dimension has more.
        dimension = rubrics.select(F.col("acronym").alias("demand"), "full_name", "content")
        assert as_rows(pair_with(prompts, dimension, limit)) == expected
    write_requests(prompts, rubrics, str(tmp_path / "small"), max_lines=3, max_bytes=None)
    monkeypatch.setattr("annomill.sinks.requests.fits_in_memory", lambda frame: False)
    write_requests(prompts, rubrics, str(tmp_path / "large"), max_lines=3, max_bytes=None)
    assert read_parts(tmp_path / "large") == read_parts(tmp_path / "small")
    write_requests(prompts, rubrics, str(tmp_path / "whole"), max_lines=None, max_bytes=None)
    assert spark.read.json(str(tmp_path / "whole")).count() == 12
    assert len(read_parts(tmp_path / "small")) == 6


def greedy_free_cuts(sizes, constant, max_lines, max_bytes):
    """Numbers of lines of each part, by going through them one by one."""
    width, begin, parts, last = max_bytes - max(sizes) - constant + 1, 0, [], None
    for size in sizes:
        stretch = begin // width
        if stretch != last or max_lines and parts[-1] == max_lines:
            parts.append(0)
        parts[-1] += 1
        last, begin = stretch, begin + size + constant
    return parts


@pytest.mark.parametrize("max_lines,block_rows", [(None, 3), (7, 64), (1, 1 << 16)])
def test_exact_cuts_are_those_of_one_pass(spark, rubrics, max_lines, block_rows):
    rng = random.Random(block_rows)
    sizes = [rng.choice([1, 5, 40, 700]) for _ in range(150)]
    indexed = spark.createDataFrame([(i, s, 150) for i, s in enumerate(sizes)], "row_index long, varying int, n_rows long").repartition(5)
    smallest = exact_cuts(indexed.limit(0), rubrics, max_lines, 10 ** 6, block_rows=block_rows)
    assert smallest.count() == 0
    constant = max(r.n_bytes for r in request_sizes(spark.createDataFrame([("", "")], "custom_id string, prompt string"), rubrics).collect())
    for limit in (constant + 700, constant + 701, 3 * constant + 2000, 10 ** 7):
        parts = exact_cuts(indexed, rubrics, max_lines, limit, block_rows=block_rows).sort("part_no").collect()
        expected = greedy_free_cuts(sizes, constant, max_lines, limit)
        assert [r.part_rows for r in parts] == expected
        assert [(r.part_no, r.first_index) for r in parts] == [(n + 1, sum(expected[:n])) for n in range(len(expected))]
        frame = spark.createDataFrame([tuple(r) for r in parts], "part_no long, first_index long, part_rows long")
        dealt = deal_exactly(indexed, frame, block_rows).sort("row_index").collect()
        assert [(r.part_no, r.part_row) for r in dealt] == [(n + 1, i) for n, count in enumerate(expected) for i in range(count)]
        assert max(sum(sizes[r.first_index:r.first_index + r.part_rows]) + r.part_rows * constant for r in parts) <= limit
    with pytest.raises(ValueError, match="more than"):
        exact_cuts(indexed, rubrics, max_lines, constant + 699, block_rows=block_rows)


@pytest.mark.parametrize("many_rubrics", [False, True])
def test_no_part_is_larger_than_allowed(spark, tmp_path, rubrics, monkeypatch, many_rubrics):
    if many_rubrics:
        monkeypatch.setattr("annomill.sinks.requests.fits_in_memory", lambda frame: False)
    rng = random.Random(4)
    # A run of long prompts, which even cuts by the mean would put into one part.
    rows = [(f"{i:03}", "é\n" * (900 if 40 <= i < 60 else rng.randrange(5))) for i in range(100)]
    prompts = spark.createDataFrame(rows, "custom_id string, prompt string")
    limit = 40_000
    sizes = {}
    for cuts in ("even", "exact"):
        path = tmp_path / cuts
        write_requests(prompts, rubrics, str(path), max_lines=30, max_bytes=limit, cuts=cuts)
        files = list(path.glob("demand=*/part=*/*.json"))
        sizes[cuts] = [f.stat().st_size for f in files]
        ids = {}
        for f in sorted(files, key=lambda f: (f.parent.parent.name, int(f.parent.name.rpartition("part")[2]))):
            lines = f.read_text("utf-8").splitlines()
            assert len(lines) <= 34
            ids.setdefault(f.parent.parent.name, []).extend(json.loads(line)["custom_id"] for line in lines)
        assert set(map(tuple, ids.values())) == {tuple(i for i, _ in rows)}
        assert len(files) == len({f.parent for f in files})
    assert max(sizes["exact"]) <= limit < max(sizes["even"])
    with pytest.raises(ValueError, match="cuts"):
        write_requests(prompts, rubrics, str(tmp_path / "x"), cuts="greedy")
    with pytest.raises(ValueError, match="max_bytes"):
        write_requests(prompts, rubrics, str(tmp_path / "x"), cuts="exact", max_bytes=None)
