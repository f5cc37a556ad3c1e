"""The wide table of a stream against the forms made from all files at once."""

import json
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from annomill.plans.runs import collect_run
from annomill.streaming.outputs import landing_outputs
from annomill.streaming.wide import WideTable

DEMANDS = ["AA", "AB", "CD"]


def land(base, run, part, rng, count=40, name="output.jsonl"):
    folder = base / run / part
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w") as f:
        for _ in range(count):
            body = {"model": "m", "choices": [{"finish_reason": rng.choice(["stop", "stop", "length"]),
                                               "message": {"content": f"x\n\nis {rng.randrange(8)}"}}]}
            f.write(json.dumps({"custom_id": str(rng.randrange(25)), "response": {"body": body}}) + "\n")


def text(frame):
    """Rows as JSON, in which NaN equals NaN and maps have an order."""
    shown = [F.to_json(F.struct(F.array_sort(F.map_entries(c)))) if dict(frame.dtypes)[c].startswith("map")
             else F.col(c).cast("string") for c in frame.columns]
    return sorted((tuple(r) for r in frame.select(*shown).collect()), key=repr)


def plan_of(frame):
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


@pytest.fixture
def made(spark, tmp_path):
    class Made:
        base, path, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
        table = WideTable(spark, path, DEMANDS, 8)

        def drain(self):
            self.table.stream(landing_outputs(spark, str(self.base), max_files=1), self.checkpoint).awaitTermination()

        def same(self):
            run = collect_run(spark, str(self.base), by_run=True)
            assert text(self.table.wide(by_run=True)) == text(run.wide(DEMANDS))
            assert text(self.table.nested(by_run=True)) == text(run.nested(DEMANDS))

    return Made()


def test_same_as_all_files_at_once(spark, made):
    rng = random.Random(5)
    with pytest.raises(FileNotFoundError):
        made.table.rows()
    for number, (run, part) in enumerate([("r1", "AA_part1"), ("r1", "AB"), ("r2", "AA"), ("r1", "AA_part2"), ("r1", "CD"), ("r2", "CD")]):
        land(made.base, run, part, rng)
        made.drain()
        made.same()
        if number % 2:
            made.table.upsert()
            made.same()
            assert [n for n in os.listdir(made.path)] == [f"upto={number}"]
    # Nothing new: neither a drain nor an upsert changes anything.
    made.drain()
    made.table.upsert()
    made.same()


def test_a_base_is_read_where_it_lies(spark, made):
    rng = random.Random(6)
    land(made.base, "r1", "AA", rng)
    made.drain()
    made.table.upsert()
    assert "Exchange" not in plan_of(made.table.wide())
    land(made.base, "r1", "AB", rng)
    made.drain()
    plan = plan_of(made.table.wide())
    # The new rows move to be grouped, and to where the base lies; the base does not.
    base = plan[plan.index("== Physical Plan =="):].split("\n\n")[0]
    assert "Bucketed: true" in plan and "SortMergeJoin FullOuter" in plan
    left = base[base.index("SortMergeJoin"):].split("Scan parquet")[0]
    assert "Exchange" not in left
    # A session that knows nothing of the base learns of it.
    for table in spark.catalog.listTables():
        if table.name.startswith("annomill_wide"):
            spark.sql(f"DROP TABLE {table.name}")
    made.same()
    assert re.search("Bucketed: true", plan_of(made.table.wide()))


def test_repeated_micro_batches_change_nothing(spark, made, tmp_path):
    rng = random.Random(7)
    land(made.base, "r1", "AA", rng)
    made.drain()
    land(made.base, "r2", "AB", rng)
    made.drain()
    made.same()
    # The driver ends after the folder is written and before the micro-batch is committed.
    commits = sorted(n for n in os.listdir(f"{made.checkpoint}/commits") if n.isdigit())
    for name in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{made.checkpoint}/commits/{name}")
    made.drain()
    made.same()
    # The same after an upsert that took the folder in.
    made.table.upsert()
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{made.checkpoint}/commits/{name}"):
            os.remove(f"{made.checkpoint}/commits/{name}")
    made.drain()
    made.same()


def test_an_upsert_that_breaks_off_changes_nothing(spark, made):
    land(made.base, "r1", "AA", random.Random(8))
    made.drain()
    # Not complete: it has no mark of success.
    shutil.copytree(f"{made.path}/epoch=0", f"{made.path}/upto=0")
    os.remove(f"{made.path}/upto=0/_SUCCESS")
    made.same()
    made.table.upsert()
    made.same()
    assert os.listdir(made.path) == ["upto=0"]


def test_unknown_demands_fail(spark, made):
    land(made.base, "r1", "ZZ", random.Random(9))
    with pytest.raises(Exception, match="a demand that the table does not have: ZZ"):
        made.drain()
