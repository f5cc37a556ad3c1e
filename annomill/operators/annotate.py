"""From model answers to annotations: one row per prompt and demand.

Inside the engine a failed annotation has a NULL level; ``nan_levels`` turns
that into NaN for readers who expect it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import NAMED_FINISH_REASONS, OTHER_FINISH_REASON
from ..functions.levels import extract_level, finish_bucket
from .sizes import sliced_join


def _bad_row():
    """Lines that cannot be annotated: not JSON, no id, no choice, or an
    answer that stopped but is not there."""
    return (
        F.col("corrupt_record").isNotNull()
        | F.col("custom_id").isNull()
        | ~F.col("has_choice")
        | (F.col("finish_reason").eqNullSafe("stop") & F.col("content").isNull())
    )


def bad_rows(outputs: DataFrame) -> DataFrame:
    """The quarantine: bad lines with where they came from."""
    return outputs.filter(_bad_row()).select(
        "file_path", "demand", "part", "custom_id", "finish_reason", "corrupt_record"
    )


def good_rows(outputs: DataFrame, on_bad_row: str = "quarantine") -> DataFrame:
    """Outputs without bad lines (``quarantine``) or without any line of a file
    that has one (``drop_file``)."""
    good = outputs.filter(~_bad_row())
    if on_bad_row == "quarantine":
        return good
    if on_bad_row == "drop_file":
        broken = bad_rows(outputs).select("file_path").distinct()
        return sliced_join(good, broken, "file_path", "left_anti", keys=outputs)
    raise ValueError("on_bad_row must be 'quarantine' or 'drop_file'")


def _has_reason(reason: str | None):
    if reason is None:
        return F.lit(True)
    if reason == OTHER_FINISH_REASON:
        return ~F.coalesce(F.col("finish_reason").isin(*NAMED_FINISH_REASONS), F.lit(False))
    if reason in NAMED_FINISH_REASONS:
        return F.col("finish_reason").eqNullSafe(reason)
    raise ValueError("finish reason must be 'stop', 'length', 'other' or None")


def filter_finish_reason(rows: DataFrame, reason: str | None) -> DataFrame:
    """Rows of one finish bucket: ``stop``, ``length``, ``other``; None keeps all."""
    wanted = _has_reason(reason)
    return rows if reason is None else rows.filter(wanted)


def _has_outcome(only_succeed: bool, only_failed: bool):
    if only_succeed and only_failed:
        raise ValueError("only_succeed and only_failed exclude each other")
    if only_succeed:
        return F.col("level").isNotNull()
    return F.col("level").isNull() if only_failed else F.lit(True)


def filter_outcome(
    annotations: DataFrame, only_succeed: bool = False, only_failed: bool = False
) -> DataFrame:
    wanted = _has_outcome(only_succeed, only_failed)
    return annotations.filter(wanted) if only_succeed or only_failed else annotations


def annotate_long(
    outputs: DataFrame,
    finish_reason: str | None = None,
    only_succeed: bool = False,
    only_failed: bool = False,
    only_levels: bool = False,
    on_bad_row: str = "quarantine",
    guard_section_number: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``custom_id, demand, level[, finish_reason, model_response]``.

    An answer has a level if it finished with ``stop`` and its conclusion
    names one.  The finish reason is filtered before any text is searched.
    ``keep`` passes further input columns through, for example the order
    columns that the wide forms need.
    """
    rows = filter_finish_reason(good_rows(outputs, on_bad_row), finish_reason)
    level = F.when(
        F.col("finish_reason") == "stop", extract_level(F.col("content"), guard_section_number)
    )
    columns = ["custom_id", "demand", level.alias("level")]
    if not only_levels:
        columns += ["finish_reason", F.col("content").alias("model_response")]
    return filter_outcome(rows.select(*columns, *keep), only_succeed, only_failed)


def annotate_marked(
    outputs: DataFrame,
    finish_reason: str | None = None,
    only_succeed: bool = False,
    only_failed: bool = False,
    only_levels: bool = False,
    guard_section_number: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Annotations and bad lines together, told apart by ``quarantined``; one pass.

    ``custom_id, demand, part, level[, finish_reason, model_response], file_path,
    corrupt_record``: the last two are for bad lines, which have no level.  ``keep``
    passes further input columns through.
    """
    bad = _bad_row()
    answer = F.when(~bad & (F.col("finish_reason") == "stop"), extract_level(F.col("content"), guard_section_number))
    marked = outputs.withColumn("quarantined", bad).withColumn("level", answer)
    rows = marked.where(F.col("quarantined") | _has_reason(finish_reason) & _has_outcome(only_succeed, only_failed))
    texts = [] if only_levels else ["finish_reason", F.col("content").alias("model_response")]
    return rows.select(
        "custom_id", "demand", "part", "level", *texts, "quarantined",
        F.when(F.col("quarantined"), F.col("file_path")).alias("file_path"), "corrupt_record", *keep,
    )


def only_levels(annotations: DataFrame) -> DataFrame:
    return annotations.select("custom_id", "demand", "level")


def with_finish_bucket(rows: DataFrame) -> DataFrame:
    return rows.withColumn("finish_bucket", finish_bucket(F.col("finish_reason")))


def nan_levels(annotations: DataFrame, *columns: str) -> DataFrame:
    """NULL levels as NaN, for readers outside the engine."""
    for name in columns or ("level",):
        annotations = annotations.withColumn(name, F.coalesce(name, F.lit(float("nan"))))
    return annotations
