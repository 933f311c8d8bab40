"""Run-metrics files, one JSON document per measurement session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators.runs import SUMMARY_DIGITS
from broadsheet.schema import RUN

_SUMMARY = ", ".join(f"{c}: double" for c in SUMMARY_DIGITS)
FILE_SCHEMA = f"runs array<{RUN.simpleString()}>, summary struct<{_SUMMARY}>"
# the file itself, or the folder Spark wrote it as, perhaps as the value of a partition column
_NAME = r"(?:[^/=]*=)?([^/=]+)_scraper_metrics(?:_[^/]*)?\.json"


def newest_files(spark: SparkSession, path: str) -> DataFrame:
    """The newest metrics file of each collector, ``scraper, file``, from names and times alone: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select(
        F.regexp_extract("path", _NAME, 1).alias("scraper"),
        F.struct(F.col("modificationTime").alias("at"), F.col("path").alias("file")).alias("version"),
    )
    newest = named.filter("scraper <> ''").groupBy("scraper").agg(F.max("version").alias("_v"))
    return newest.select("scraper", "_v.file")


def latest_run_files(spark: SparkSession, path: str) -> DataFrame:
    """The newest metrics file of each collector: ``scraper, file, runs, summary``. Older files are not parsed."""
    newest = newest_files(spark, path).collect()  # one row per collector
    if not newest:
        return spark.createDataFrame([], f"scraper string, file string, {FILE_SCHEMA}")
    files = spark.read.schema(FILE_SCHEMA).option("multiLine", True).json([r["file"] for r in newest])
    file = F.col("_metadata.file_path")
    return files.select(F.regexp_extract(file, _NAME, 1).alias("scraper"), file.alias("file"), "runs", "summary")


def runs_of(files: DataFrame) -> DataFrame:
    return files.select("scraper", F.inline("runs"))


def summaries_of(files: DataFrame) -> DataFrame:
    return files.filter("summary is not null").select("scraper", "summary.*")


def write_run_file(runs: DataFrame, summary: DataFrame, folder: str, scraper: str, stamp: str) -> None:
    """Save one session of one collector; a session is a handful of runs, so it is one document."""
    mine = runs.filter(F.col("scraper") == scraper)
    nested = mine.agg(F.sort_array(F.collect_list(F.struct(*RUN.names))).alias("runs"))
    figures = summary.filter(F.col("scraper") == scraper).select(F.struct(*SUMMARY_DIGITS).alias("summary"))
    document = nested.withColumn("summary", figures.scalar())
    document.coalesce(1).write.mode("overwrite").json(f"{folder}/{scraper}_scraper_metrics_{stamp}.json")


def write_run_files(runs: DataFrame, folder: str, session: str = "session") -> None:
    """Save the runs of many sessions in one job, a document per collector and session, which is a handful of runs."""
    documents = runs.groupBy("scraper", session).agg(F.sort_array(F.collect_list(F.struct(*RUN.names))).alias("runs"))
    name = F.concat("scraper", F.lit("_scraper_metrics_"), F.col(session).cast("string"), F.lit(".json"))
    text = F.to_json(F.struct("runs")).alias("value")
    documents.select(text, name.alias("file")).write.mode("append").partitionBy("file").text(folder)
