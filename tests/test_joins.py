import pytest
from pyspark.sql import functions as F

from annomill.operators.lookups import (
    attach_prompts, completed_by_output, completed_jobs, jobs_in_ledger, missing_annotations, missing_parts,
)
from annomill.operators.reshape import nest_wide, pivot_wide, unnest_wide
from annomill.operators.sizes import fits_in_memory, hot_slices, sliced_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, some without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        (F.col("id") % 97).cast("string"))
    return spark.range(0, 3000, 1, 6).select(key.alias("k"), "id")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("hot", "H")] + [(str(i), f"n{i}") for i in range(60)], "k string, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_is_the_plain_join(skewed, names, how, as_rows):
    columns = ["id", "k"] + (["name"] if how in ("inner", "left") else [])
    sliced = sliced_join(skewed, names, "k", how, slice_rows=100)
    assert as_rows(sliced, *columns) == as_rows(skewed.join(names, "k", how), *columns)


def test_places_may_come_with_the_rows(skewed, names, as_rows):
    placed = skewed.select("*", F.lit("f").alias("file_path"), F.lit(0).alias("file_block"), F.col("id").alias("file_pos"))
    sliced = sliced_join(placed.repartition(4), names, "k", "left", slice_rows=100, keys=skewed)
    assert as_rows(sliced, "id", "k", "name") == as_rows(skewed.join(names, "k", "left"), "id", "k", "name")


def test_hot_keys(skewed, as_rows):
    assert as_rows(hot_slices(skewed, "k", 100)) == [("hot", 10)]
    assert hot_slices(skewed, "k", 10_000).count() == 0


def test_sliced_join_rejects_what_it_cannot_do(skewed, names):
    with pytest.raises(ValueError):
        sliced_join(skewed, names, "k", "full")


def test_hot_rows_are_spread(spark, skewed, names):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(frame):
            hot = frame.filter("k = 'hot'").groupBy(F.spark_partition_id()).count()
            return hot.agg(F.max("count")).first()[0]

        assert largest(skewed.join(names, "k")) == 1000
        assert largest(sliced_join(skewed, names, "k", slice_rows=50)) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_measured_size(names):
    assert fits_in_memory(names)
    assert not fits_in_memory(names, 100)


def test_attach_prompts(spark, as_rows):
    long = spark.createDataFrame([("a", "X", 1.0), ("a", "Y", 2.0), ("b", "X", None)], "custom_id string, demand string, level double")
    prompts = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "custom_id string, prompt string, ord int")
    for slice_rows in (1, 1000):
        found = attach_prompts(long, prompts, F.col("ord"), slice_rows)
        assert as_rows(found, "custom_id", "demand", "prompt") == [("a", "X", "new"), ("a", "Y", "new"), ("b", "X", "")]


@pytest.fixture(scope="module")
def ledger(spark):
    return spark.createDataFrame([("A", "A_part1", "b1"), ("A", "A_part2", "b2"), ("C", "C", "b3")],
                                 "demand string, part string, batch_id string")


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame([("b1", "completed"), ("b2", "failed"), ("b9", "completed")], "id string, status string")


def test_jobs(spark, ledger, jobs, as_rows):
    assert as_rows(jobs_in_ledger(jobs, ledger), "id", "part") == [("b1", "A_part1"), ("b2", "A_part2")]
    assert as_rows(jobs_in_ledger(jobs, ledger, "completed"), "id") == [("b1",)]
    assert jobs_in_ledger(jobs).count() == 3
    assert as_rows(jobs_in_ledger(jobs, ledger.limit(0), "completed"), "id") == [("b1",), ("b9",)]
    assert as_rows(completed_jobs(ledger, jobs), "part") == [("A_part1",)]
    outputs = spark.createDataFrame([("C",), ("C",)], "part string")
    assert as_rows(completed_by_output(ledger, outputs), "batch_id") == [("b3",)]
    assert as_rows(missing_parts(ledger, outputs)) == [("A", "A_part1"), ("A", "A_part2")]


def test_missing_annotations(spark, as_rows):
    prompts = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "custom_id string, prompt string")
    outputs = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", "Y"), ("c", "X"), ("b", "Q")], "custom_id string, demand string")
    assert as_rows(missing_annotations(prompts, outputs, ["X", "Y"])) == [("b", "X")]


LONG = [("a", "X", 1.0, 1), ("a", "X", None, 2), ("a", "Y", 3.0, 1), ("b", "Y", 0.0, 5), ("b", "Y", 4.0, 4)]


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(LONG, "custom_id string, demand string, level double, ord int")


def test_pivot(spark, long, as_rows):
    assert as_rows(pivot_wide(long, F.col("ord"), failures_as="null")) == [("a", None, 3.0), ("b", None, 0.0)]
    wide = pivot_wide(long, F.col("ord"), ["Y", "X", "Z"])
    assert wide.columns == ["custom_id", "Y", "X", "Z"]
    assert wide.filter(F.isnan("X")).count() == 2 and wide.filter(F.isnan("Z")).count() == 2
    with pytest.raises(Exception, match="several annotations"):
        pivot_wide(long, F.col("ord"), on_duplicate="error").collect()
    once = long.filter("ord in (1, 5)")
    assert as_rows(pivot_wide(once, F.col("ord"), on_duplicate="error", failures_as="null")) == [
        ("a", 1.0, 3.0), ("b", None, 0.0)]
    for wrong in ({"on_duplicate": "first"}, {"failures_as": "zero"}):
        with pytest.raises(ValueError):
            pivot_wide(long, F.col("ord"), **wrong)


def test_nested_is_the_deduplicated_long_form(spark, as_rows):
    rows = [(f"c{i % 40}", f"D{i % 7}", float(i % 6) if i % 5 else None, f"r{i % 3}", f"text {i}", f"p{i % 40}", (i * 37) % 1009)
            for i in range(1000)]
    long = spark.createDataFrame(
        rows, "custom_id string, demand string, level double, finish_reason string, model_response string, prompt string, ord int")
    nested = nest_wide(long, F.col("ord"), failures_as="null")
    assert nested.columns == ["custom_id", "demand", "prompt"]
    last = {}
    for row in sorted(rows, key=lambda r: r[-1]):
        last[row[:2]] = row[2:5]
    expected = sorted(((*key, *value) for key, value in last.items()), key=repr)
    assert as_rows(unnest_wide(nested), "custom_id", "demand", "level", "finish_reason", "model_response") == expected
    levels = nest_wide(long.select("custom_id", "demand", "level", "ord"), F.col("ord"))
    assert levels.select("demand").schema.simpleString() == "struct<demand:map<string,struct<level:double>>>"
