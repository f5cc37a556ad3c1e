"""Exact deduplication of a stream of documents with keyed state on disk.

Texts are equal when they are alike after white space is taken out.  The stream
keeps, for each digest of such a text, how often it came, the stable identifier of
the row that stays and where that row's content lies (file and row).  The state is
a RocksDB store in the shared folder and never expires: a copy is found however
late it comes.  Each micro-batch writes the entries it changed to a folder of its
own, which a repeated micro-batch overwrites; the entry with the highest count is
the newest.

A digest that comes again is a *hit*.  The hits' whole texts are compared with the
content at the entry's place; what differs in spite of an equal digest is grouped
by its whole text instead.

Copies are counted before they move, so a digest that holds a third of all rows is
no hot spot; texts move only for the comparison, and only those of hits.

Defined cases: a NULL text counts as empty, and empty texts are equal; a NULL id
gives way to any other; rows alike in everything are told apart by their place, the
last one stays; an empty folder's table gives an empty table; columns other than
the two named ones are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch, stored
from .lines import possible

#: Bytes of input of a micro-batch.
BATCH_BYTES = 256 << 30
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Else each state partition sets some MB aside that it never fills.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
ENTRY = "digest string, group_size long, best struct<points: int, order: long, doc_id: long, file: string, row: long>"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame, id_column: str, text_column: str, digest) -> DataFrame:
    """``doc_id, digest, points, file, row, whole``: a row, its place and its normalised text."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("original"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = rows.withColumn("whole", normalised(F.col("original")))
    return rows.select("doc_id", digest(F.col("whole")).alias("digest"), F.length("original").alias("points"),
                       "file", "row", "whole")


def newest(entries: DataFrame) -> DataFrame:
    """One entry per digest."""
    return entries.groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max("best").alias("best"))


def folder_of(spark: SparkSession, source: str) -> tuple[str, str]:
    """A folder to watch and a pattern for the names in it; a stream cannot watch a single file."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(place).isFile():
        return place.getParent().toString(), place.getName()
    return source, "*"


@contextmanager
def keyed_state(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def update_state(spark: SparkSession, source: str, home: str, id_column: str = "doc_id", text_column: str = "text",
                 digest=sha256, batch_bytes: int = BATCH_BYTES, files: int | None = None) -> DataFrame:
    """Takes in what is new in a folder of Parquet files (or a single file); the entries of all that came so far.

    ``home`` holds the state; called again with it, only new files are read.
    """
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader.option("maxBytesPerTrigger", batch_bytes)
    folder, name = folder_of(spark, source)
    rows = located(reader.option("pathGlobFilter", name).parquet(folder), id_column, text_column, digest)
    best = F.struct("points", F.bitwise_not("doc_id").alias("order"),
                    "doc_id", "file", "row")
    entries = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(best).alias("best"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/entries/epoch={epoch}")

    with keyed_state(spark):
        query = (entries.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start())
        query.awaitTermination()
    spark.createDataFrame([], ENTRY).write.mode("overwrite").parquet(f"{home}/entries/epoch=-1")
    return newest(spark.read.schema(ENTRY).parquet(f"{home}/entries"))


def deduplicated(spark: SparkSession, source: str, home: str | None = None, id_column: str = "doc_id",
                 text_column: str = "text", digest=sha256, **options) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest, text_sha256`` of every row in the folder."""
    home = home or new_scratch(spark, "exact-state")
    entries = stored(update_state(spark, source, home, id_column, text_column, digest, **options), "exact-entries")
    rows = located(spark.read.parquet(source), id_column, text_column, digest)
    whole = rows.withColumn("text_sha256", sha256(F.col("whole")) if digest is not sha256 else F.col("digest"))
    odd = stored(collisions(rows, entries), "exact-collisions")
    judged = whole.drop("whole", "points").join(entries, "digest")
    if not odd.isEmpty():
        judged = judged.join(odd.select("file", "row"), ["file", "row"], "left_anti")
        fewer = odd.groupBy("digest").count()
        judged = judged.join(fewer, "digest", "left").withColumn(
            "group_size", F.col("group_size") - F.coalesce("count", F.lit(0))).drop("count")
        judged = judged.unionByName(regrouped(odd).select(judged.columns))
    kept = (F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))
    return judged.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"),
                         "digest", "text_sha256")


def collisions(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Hits whose whole text differs from the content at their entry's place."""
    several = entries.where("group_size > 1").select(
        "digest", F.col("best.file").alias("_file"), F.col("best.row").alias("_row"))
    # An inner join: a semi join would be moved below the bitmap and shuffle every text.
    hits = stored(possible(rows, "digest", several).join(several, "digest"), "exact-hits")
    content = hits.where("file = _file AND row = _row").select("digest", F.col("whole").alias("content"))
    return hits.join(content, "digest").where("whole <> content").select(rows.columns)


def regrouped(odd: DataFrame) -> DataFrame:
    """Rows with a digest that is not their own, grouped by their whole text."""
    best = F.struct("points", F.bitwise_not("doc_id").alias("order"), "doc_id", "file", "row")
    groups = odd.groupBy("whole").agg(F.count(F.lit(1)).alias("group_size"), F.max(best).alias("best"))
    return odd.join(groups, "whole").withColumn("text_sha256", sha256(F.col("whole")))
