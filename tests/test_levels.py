import pytest
from pyspark.sql import functions as F

from annomill.functions.levels import extract_level, finish_bucket
from annomill.functions.paths import demand_of_path, part_of_path, stem_of_path
from annomill.functions.pricing import price_of

LEVELS = [
    ("a\n\nis: 3", 3.0),
    ("a\n\n4. Conclusion: Not Applicable", 4.0),
    ("x 3/5", 5.0),
    ("a\n\nis: 10", None),
    ("a\n\nis: 3\n\n", None),
    ("is -3", 3.0),
    ("is 3.5", 5.0),
    ("a\n\nlevel ٣", None),
    ("", None),
    ("9" * 400, None),
    ("a\n\n4.0 only", 0.0),
    ("is 5\n\n\nis 2", 2.0),
    ("007", None),
    ("is 05", 5.0),
    ("is 000", 0.0),
    ("7\n\n1 then 6", None),
    ("3", 3.0),
    ("level **4**\n", 4.0),
    (None, None),
]


def test_levels(spark):
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(LEVELS)], "i int, text string")
    found = {row["i"]: row["level"] for row in frame.select("i", extract_level(F.col("text")).alias("level")).collect()}
    assert [found[i] for i in range(len(LEVELS))] == [level for _, level in LEVELS]


def test_guard_drops_a_lone_leading_number(spark):
    texts = ["a\n\n4. Not Applicable", "a\n\n4. so it is 3", "a\n\nis 4", "4"]
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    guarded = extract_level(F.col("text"), guard_section_number=True)
    found = [row[0] for row in frame.select(guarded, "i").sort("i").collect()]
    assert found == [None, 3.0, 4.0, None]


def test_long_digit_runs_take_linear_time(spark):
    long = "0" * 200_000 + "x" + "12" * 200_000 + " is 3"
    assert spark.createDataFrame([(long,)], "t string").select(extract_level(F.col("t"))).first()[0] == 3.0


@pytest.mark.parametrize("reason, bucket", [
    ("stop", "stop"), ("length", "length"), ("content_filter", "other"), ("", "other"), (None, "other"),
])
def test_finish_bucket(spark, reason, bucket):
    frame = spark.createDataFrame([(reason,)], "reason string")
    assert frame.select(finish_bucket(F.col("reason"))).first()[0] == bucket


PRICES = [
    # model, first key, longest key
    ("gpt-4o-mini-2024", "gpt-4o", "gpt-4o-mini"),
    ("gpt-5-mini", "gpt-5", "gpt-5-mini"),
    ("gpt-5.2-pro", "gpt-5.2", "gpt-5.2-pro"),
    ("o4-mini", "o4-mini", "o4-mini"),
    ("o3-mini", "o3", "o3-mini"),
    ("gpt-4o-global-batch", "gpt-4o", "gpt-4o"),
    ("gpt-4-turbo-preview", "gpt-4", "gpt-4-turbo"),
    ("zzz", None, None),
    (None, None, None),
]


def test_price_keys(spark):
    frame = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PRICES)], "i int, model string")
    model = F.col("model")
    found = frame.select("i", price_of(model).alias("f"), price_of(model, match="longest").alias("l")).sort("i").collect()
    assert [(row["f"]["model_key"], row["l"]["model_key"]) for row in found] == [p[1:] for p in PRICES]
    assert found[0]["f"]["input"] == 1.25 and found[0]["l"]["output"] == 0.3
    assert found[-2]["f"].asDict() == {"model_key": None, "input": 0.0, "output": 0.0, "found": False}
    with pytest.raises(ValueError):
        price_of(model, match="any")


@pytest.mark.parametrize("path, demand, part", [
    ("file:/b/AA/output.jsonl", "AA", "AA"),
    ("file:/b/AA_part12/output.jsonl", "AA", "AA_part12"),
    ("file:/b/demand=My_Own/part=My_Own_part2/x.json", "My_Own", "My_Own_part2"),
    ("file:/b/part=CE_part2/x.json", "CE", "CE_part2"),
])
def test_paths(spark, path, demand, part):
    frame = spark.createDataFrame([(path,)], "p string")
    assert tuple(frame.select(demand_of_path(F.col("p")), part_of_path(F.col("p"))).first()) == (demand, part)


def test_stem(spark):
    frame = spark.createDataFrame([("file:/r/MCt.txt",)], "p string")
    assert frame.select(stem_of_path(F.col("p"))).first()[0] == "MCt"
