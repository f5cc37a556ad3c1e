"""The two halves of an annotation run; the model service sits between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pricing import Prices
from ..fixed_values import MODEL_PRICES
from ..operators.annotate import annotate_long, annotate_marked, bad_rows
from ..operators.lookups import attach_prompts
from ..operators.positions import POSITION
from ..operators.requests import filter_demands
from ..operators.reshape import demands_in, nest_wide, pivot_wide
from ..operators.usage import (
    annotation_summary, batch_summary, batch_usage, failed_breakdown, general_summary,
)
from ..sinks.layout import write_by_id
from ..sinks.requests import write_requests
from ..sources.outputs import line_order, read_outputs
from ..sources.prompts import only_prompts, prompt_map, read_prompts
from ..sources.rubrics import load_rubrics


def create_requests(
    spark: SparkSession,
    prompt_path: str,
    rubric_folder: str,
    path: str,
    demands: str | Sequence[str] | None = None,
    prompt_format: str = "jsonl",
    **options,
) -> None:
    """Prompt files and rubric files to request files."""
    rubrics = load_rubrics(spark, rubric_folder)
    if demands is not None:
        rubrics = filter_demands(rubrics, demands)
    prompts = read_prompts(spark, prompt_path, prompt_format, position=True)
    write_requests(prompts, rubrics, path, **options)


@dataclass(frozen=True)
class KeptRun:
    """A run in tables by id: each form reads them bucket by bucket."""

    rows: DataFrame
    prompts: DataFrame | None
    demands: tuple[str, ...]
    by_run: bool = False

    def _with_prompts(self, frame: DataFrame) -> DataFrame:
        if self.prompts is None:
            return frame
        # Merged as they lie; a broadcast would carry the prompts around.
        joined = frame.join(self.prompts.hint("merge"), "custom_id", "left")
        return joined.select(*frame.columns, F.coalesce("prompt", F.lit("")).alias("prompt"))

    def _rows(self) -> dict:
        return {"by": ("run", "custom_id")} if self.by_run else {"alike": "run"}

    def long(self) -> DataFrame:
        run = ["run"] if self.by_run else []
        own = [name for name in self.rows.columns if name not in ("run", *POSITION)]
        return self._with_prompts(self.rows.select(*run, *own))

    def wide(self) -> DataFrame:
        return pivot_wide(self.rows, line_order(), self.demands, **self._rows())

    def nested(self) -> DataFrame:
        return self._with_prompts(nest_wide(self.rows, line_order(), self.demands, **self._rows()))


@dataclass(frozen=True)
class AnnotationRun:
    """Lazy views of one set of outputs.  Nothing runs until one is used.

    With ``by_run`` the outputs of several runs stay apart: the long form names the run,
    and the others have a row per run and id.  Without it an id with lines of several runs
    is an error in the wide and nested forms.
    """

    outputs: DataFrame
    usage_lines: DataFrame
    prompts: DataFrame | None = None
    options: tuple = ()
    by_run: bool = False

    def long(self) -> DataFrame:
        rows = annotate_long(self.outputs, keep=self._run(), **dict(self.options))
        rows = rows.select(*self._run(), *[name for name in rows.columns if name not in self._run()])
        return rows if self.prompts is None else attach_prompts(rows, self.prompts)

    def _run(self) -> tuple[str, ...]:
        return ("run",) if self.by_run else ()

    def bad(self) -> DataFrame:
        """Every line that could not be annotated, with where it came from."""
        return bad_rows(self.outputs)

    def _ordered(self) -> DataFrame:
        return annotate_long(self.outputs, keep=("run", *POSITION), **dict(self.options))

    def _rows(self) -> dict:
        return {"by": ("run", "custom_id")} if self.by_run else {"alike": "run"}

    def wide(self, demands: Sequence[str] | None = None, order_by: Column | None = None) -> DataFrame:
        order = line_order() if order_by is None else order_by
        return pivot_wide(self._ordered(), order, demands, **self._rows())

    def nested(self, demands: Sequence[str] | None = None, order_by: Column | None = None) -> DataFrame:
        order = line_order() if order_by is None else order_by
        nested = nest_wide(self._ordered(), order, demands, **self._rows())
        if self.prompts is None:
            return nested
        return attach_prompts(nested, self.prompts)

    def kept(self, name: str, path: str, buckets: int, demands: Sequence[str] | None = None) -> KeptRun:
        """The annotations, and the prompts if there are any, as tables by id below ``path``.

        All forms are then read from them without a shuffle.  ``name`` begins the tables' names.
        """
        rows = write_by_id(self._ordered(), f"{name}_annotations", f"{path}/annotations", buckets)
        prompts = None
        if self.prompts is not None:
            source = only_prompts(self.prompts).where("custom_id IS NOT NULL")
            prompts = write_by_id(source, f"{name}_prompts", f"{path}/prompts", buckets)
        return KeptRun(rows, prompts, tuple(demands) if demands is not None else tuple(demands_in(rows)), self.by_run)

    def summary(self, *by: str) -> DataFrame:
        """Counts and shares of annotations, and ``bad``, the lines set aside; one pass."""
        narrow = {**dict(self.options), "only_levels": True}
        if narrow.pop("on_bad_row", "quarantine") == "quarantine":
            return annotation_summary(annotate_marked(self.outputs, **narrow), *by)
        return annotation_summary(annotate_long(self.outputs, on_bad_row="drop_file", **narrow), *by)

    def failures(self) -> DataFrame:
        whole = {**dict(self.options), "only_levels": False}
        return failed_breakdown(annotate_long(self.outputs, **whole))

    def usage(self) -> DataFrame:
        return batch_usage(self.usage_lines)

    def batches(self, metadata: DataFrame, prices: Prices = MODEL_PRICES) -> DataFrame:
        return batch_summary(metadata, self.usage(), prices)

    def overall(self, metadata: DataFrame, prices: Prices = MODEL_PRICES) -> DataFrame:
        return general_summary(self.batches(metadata, prices))


def collect_run(
    spark: SparkSession,
    base: str,
    file_glob: str = "output.jsonl",
    prompts: DataFrame | None = None,
    by_run: bool = False,
    **options,
) -> AnnotationRun:
    """Everything below ``base``; ``options`` are those of ``annotate_long``.

    ``by_run`` tells the runs below ``base`` apart.

    ``prompts`` read with their position may repeat ids: the last one counts.
    Without it an id with several prompts is an error.
    """
    if prompts is not None and all(name in prompts.columns for name in POSITION):
        prompts = prompt_map(prompts, line_order())
    return AnnotationRun(
        read_outputs(spark, base, file_glob), read_outputs(spark, base, file_glob, content=False),
        prompts, tuple(options.items()), by_run,
    )
