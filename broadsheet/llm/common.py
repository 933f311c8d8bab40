"""What the operators of this subpackage share: tables, words, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import prepare

# fixed: the six ASCII white-space characters; anything else belongs to a word
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# rows of long texts go to Python workers in batches of this many, whatever the session's default
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; sets what the operators rely on in the session."""
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return prepare(spark)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null or blank text."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN, -1))


def hex64(value: Column) -> Column:
    """A long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# fixed: characters that mark a text as markup or code
SYMBOLS_OF_TOPIC = "#*$%&|<>{}[]=_\\"
