"""Annotations with one row per prompt, kept current while outputs land.

A micro-batch groups only its own lines: per run and id, the last line of each
demand.  Now and then ``WideTable.upsert`` merges what has come since into a *base*, which
lies in buckets by id: the base is read where it lies, only the new rows move, and
each row takes the later cell of each demand.  Readers merge the base with the
micro-batches after it in the same way, so what they see never depends on when rows
were merged, or on how files were spread over micro-batches.

A line that stands further behind in the order of the files wins, as in
``pivot_wide`` with ``line_order``; a micro-batch that is repeated overwrites its folder, and
merging the same lines again changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.annotate import annotate_long
from ..operators.positions import POSITION
from .epochs import folders, read_folders, remove_folders, write_epoch

KEYS = ("run", "custom_id")
VALUE = ("level", "finish_reason", "model_response")


class WideTable:
    """A folder with a base and micro-batches.

    ``demands`` are all that may come; a line of another one fails.  ``buckets`` should be at
    least the partitions of a shuffle, so that the base does not move when it is merged.
    """

    def __init__(self, spark: SparkSession, path: str, demands: Sequence[str], buckets: int):
        self.spark, self.path, self.demands, self.buckets = spark, path.rstrip("/"), list(demands), buckets

    # --- Rows --------------------------------------------------------------

    def _cells(self) -> list[str]:
        return [f"_{i}" for i in range(len(self.demands))]

    def partials(self, outputs: DataFrame, **annotate) -> DataFrame:
        """``run, custom_id`` and for each demand its last line with its place."""
        rows = annotate_long(outputs, keep=("run", *POSITION), **annotate)
        known = F.col("demand").isin(self.demands)
        unknown = F.raise_error(F.concat(F.lit("a line of a demand that the table does not have: "), F.col("demand")))
        cell = F.struct(*POSITION, *VALUE)
        return rows.where(F.when(known, True).otherwise(unknown)).groupBy(*KEYS).agg(*[
            F.max(F.when(F.col("demand") == demand, cell)).alias(name)
            for demand, name in zip(self.demands, self._cells())])

    def _merged(self, rows: DataFrame) -> DataFrame:
        # Dealt by the id alone, as the base is: neither a merge with it nor a new base moves the rows again.
        return rows.repartition(self.buckets, "custom_id").groupBy(*KEYS).agg(*[F.max(name).alias(name) for name in self._cells()])

    # --- Stream -------------------------------------------------------------

    def stream(self, outputs: DataFrame, checkpoint: str, trigger: dict | None = None, **annotate) -> StreamingQuery:
        """Takes in ``landing_outputs``; ``annotate`` are options of ``annotate_long``."""
        def save(landed: DataFrame, epoch: int) -> None:
            numbered = landed.withColumn("file_pos", F.monotonically_increasing_id())
            write_epoch(self.partials(numbered, **annotate), self.path, epoch)

        return (
            outputs.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(save).start()
        )

    # --- Base ---------------------------------------------------------------

    def _base(self, upto: int, fields: str) -> DataFrame:
        """The base as a table in buckets; a new session knows nothing of it, so it is told."""
        name = self._table(upto)
        if not self.spark.catalog.tableExists(name):
            place = f"{self.path}/upto={upto}".replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (custom_id) SORTED BY (custom_id) "
                f"INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return self.spark.table(name)

    def _table(self, upto: int) -> str:
        return f"annomill_wide_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}_{upto}"

    def rows(self) -> DataFrame:
        """``run, custom_id`` and the last cell of each demand, of all that has come."""
        epochs, bases = folders(self.spark, self.path)
        upto = bases[-1] if bases else -1
        new = [e for e in epochs if e > upto]
        if not new and not bases:
            raise FileNotFoundError(f"nothing was written to {self.path} yet")
        if not bases:
            return self._merged(read_folders(self.spark, [f"{self.path}/epoch={e}" for e in new]))
        fields = read_folders(self.spark, [f"{self.path}/upto={upto}"]).schema.toDDL()
        base = self._base(upto, fields)
        if not new:
            return base
        landed = self._merged(read_folders(self.spark, [f"{self.path}/epoch={e}" for e in new]))
        theirs = landed.select(*[F.col(key).alias(f"n{key}") for key in KEYS],
                               *[F.col(name).alias(f"n{name}") for name in self._cells()])
        # The id alone is what both sides are laid out by; the run, said in this way, is no key of the join.
        same_run = F.greatest("run", "nrun") == F.least("run", "nrun")
        joined = base.join(theirs.hint("merge"), (F.col("custom_id") == F.col("ncustom_id")) & same_run, "full_outer")
        return joined.select(
            *[F.coalesce(key, f"n{key}").alias(key) for key in KEYS],
            *[F.greatest(name, f"n{name}").alias(name) for name in self._cells()])

    def upsert(self) -> None:
        """Merges the micro-batches so far into a new base; to be run now and then, not beside the stream's own writes.

        The old base and the merged micro-batches go only when the new base is complete.
        """
        epochs, bases = folders(self.spark, self.path)
        upto = bases[-1] if bases else -1
        if not epochs or epochs[-1] <= upto:
            return
        # What an earlier try left is not complete.
        remove_folders(self.spark, self.path, [], [epochs[-1]])
        name = f"annomill_writing_{uuid.uuid4().hex}"
        (
            self.rows().repartition(self.buckets, "custom_id").write.mode("overwrite").format("parquet")
            .options(path=f"{self.path}/upto={epochs[-1]}", compression="zstd").bucketBy(self.buckets, "custom_id").sortBy("custom_id")
            .saveAsTable(name)
        )
        # The files stay: the table lies outside the warehouse.
        self.spark.sql(f"DROP TABLE {name}")
        for old in bases:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
        remove_folders(self.spark, self.path, epochs, bases)

    # --- Forms ----------------------------------------------------------------

    def wide(self, by_run: bool = False, failures_as: str = "nan") -> DataFrame:
        """One level column per demand, as ``pivot_wide`` gives it."""
        failed = F.lit(float("nan") if failures_as == "nan" else None).cast("double")
        cells = [F.coalesce(F.col(name)["level"], failed).alias(demand) for demand, name in zip(self.demands, self._cells())]
        return self.rows().select(*(KEYS if by_run else KEYS[1:]), *cells)

    def nested(self, by_run: bool = False, failures_as: str = "nan") -> DataFrame:
        """``custom_id, demand MAP<demand, STRUCT<level, finish_reason, model_response>>``, as ``nest_wide`` gives it."""
        def value(name: str):
            level = F.col(name)["level"]
            level = F.coalesce(level, F.lit(float("nan"))) if failures_as == "nan" else level
            return F.struct(level.alias("level"), *[F.col(name)[field].alias(field) for field in VALUE[1:]])

        entries = F.array_compact(F.array(*[
            F.when(F.col(name).isNotNull(), F.struct(F.lit(demand).alias("key"), value(name).alias("value")))
            for demand, name in zip(self.demands, self._cells())]))
        return self.rows().select(*(KEYS if by_run else KEYS[1:]), F.map_from_entries(entries).alias("demand"))
