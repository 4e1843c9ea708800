"""Writers and readers of events, documents and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_events(events: DataFrame, path: str) -> None:
    """Tag events as JSON lines."""
    events.write.mode("errorifexists").json(path)


def write_payloads(documents: DataFrame, path: str, shard: str = "shard") -> None:
    """One JSON document a row, in a folder for each shard; compressed, as a document repeats its names with every state."""
    documents.select(shard, F.col("document").alias("value")).write.partitionBy(shard).option("compression", "gzip").text(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A summary of few rows as JSON in one file."""
    summary.coalesce(1).write.json(path)


def read_payloads(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(readable documents, diagnostics: file and text of what can't be read)."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    rows = rows.withColumn("d", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    return rows.filter("d._bad IS NULL").select("file", "d.*").drop("_bad"), rows.filter("d._bad IS NOT NULL").select("file", F.col("value").alias("text"))


def index_payloads(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(scenario_id, file, n_frames, n_events, tags) of the readable documents below a path, and the diagnostics of the others: the index knows the files and not what they were made from."""
    told, broken = read_payloads(spark, path, "scenario_id string, frames array<struct<step_index:int>>, events array<struct<tag_name:string>>")
    lacking = F.col("scenario_id").isNull() | F.col("frames").isNull()
    index = told.filter(~lacking).select("scenario_id", "file", F.size("frames").alias("n_frames"), F.coalesce(F.size("events"), F.lit(0)).alias("n_events"), F.array_sort(F.array_distinct(F.coalesce(F.col("events.tag_name"), F.array().cast("array<string>")))).alias("tags"))
    return index, broken.unionByName(told.filter(lacking).select("file", F.lit(None).cast("string").alias("text")))
