"""The table of stored windows: merged by key, read by range, retained by day, exported per source.

A batch of window rows adds files under a name of their own and then one small file to
the commit log, which names the files that are live for each day. Rows with the window
and analysis type of a stored row replace it; all others of their day stay. A batch id
that the log knows changes nothing, so a repeated delivery is harmless, and a batch that
fails before its log entry leaves no trace but unused files, which ``vacuum`` removes.
Files never change, so a reader keeps the state it was planned on. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.session import exists, list_paths, remove

ANALYSIS_TYPE = "sliding_window"

EXPORT_COLUMNS = ["window_start", "window_end", "total_articles", "publishing_rate", "avg_title_length", "avg_desc_length"]


def to_results(view: DataFrame, created_at: Column, analysis_type: str = ANALYSIS_TYPE) -> DataFrame:
    """Window rows as stored results: the whole row is kept as JSON."""
    return view.select(
        "window_start",
        "window_end",
        F.lit(analysis_type).alias("analysis_type"),
        F.to_json(F.struct(*view.columns)).alias("results"),
        created_at.alias("created_at"),
    )


KEY = ("window_start", "window_end", "analysis_type")
LOG = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("batch", T.StringType()),
        T.StructField("day", T.DateType()),  # null in the entry of the batch itself
        T.StructField("files", T.StringType()),  # null where the day is dropped
        T.StructField("n_windows", T.LongType()),
        T.StructField("schema", T.StringType()),
    ]
)


def _both(a: T.StructType, b: T.StructType) -> T.StructType:
    return T.StructType(list({f.name: f for f in (*a, *b)}.values()))


class WindowStore:
    """Stored windows in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- the log ----

    def log(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/commits")

    def live(self, first: Column | None = None, last: Column | None = None) -> DataFrame:
        """``day, files, n_windows`` of the days that hold rows, within an optional range."""
        entries = self.log().filter("day is not null")
        if first is not None:
            entries = entries.filter(F.col("day") >= first)
        if last is not None:
            entries = entries.filter(F.col("day") <= last)
        newest = entries.groupBy("day").agg(F.max_by(F.struct("files", "n_windows"), "seq").alias("_e"))
        return newest.select("day", "_e.*").filter("files is not null")

    def _last(self) -> tuple[int, T.StructType | None]:
        """Number of the last commit and the schema of its rows."""
        found = self.log().agg(F.max("seq"), F.max_by("schema", "seq")).first()
        return found[0] or 0, T.StructType.fromJson(json.loads(found[1])) if found[1] else None

    def _commit(self, batch: str, schema: T.StructType, days: dict[date, tuple[str | None, int]]) -> None:
        seq = self._last()[0] + 1
        entries = [(seq, batch, None, None, None, schema.json())]
        entries += [(seq, batch, day, files, n, schema.json()) for day, (files, n) in days.items()]
        # one file, so that the commit appears as a whole
        self.spark.createDataFrame(entries, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        if self.log().filter((F.col("seq") == seq) & (F.col("batch") != batch)).first():
            raise RuntimeError(f"a second writer has committed to {self.path}")

    # ---- rows ----

    def _read(self, schema: T.StructType, days: dict[date, str]) -> DataFrame:
        if not days:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{files}/day={day}" for day, files in sorted(days.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def merge(self, df: DataFrame, batch: str) -> bool:
        """Add or replace the rows of a batch; False, and no change, if the batch was committed before.

        Rows of one batch should differ in window or analysis type; those that do not are all kept.
        """
        if self.log().filter(F.col("batch") == batch).first():
            return False
        name = uuid.uuid4().hex
        self._write(df, name)
        staged = self._written(df.schema, name)
        sizes = F.count_distinct("window_start")
        new = {d: (name, n) for d, n in staged.groupBy("day").agg(sizes).collect()}
        old = {d: f for d, f, _ in self.live(F.lit(min(new)), F.lit(max(new))).collect() if d in new} if new else {}
        if old:
            # days that hold rows already are written anew, in full
            _, schema = self._last()
            again = staged.filter(F.col("day").isin(list(old))).drop("day")
            same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY if c in df.columns]
            stored = self._read(_both(schema, df.schema), old)
            rows = stored.alias("s").join(again.alias("b"), same, "left_anti").unionByName(again, allowMissingColumns=True)
            merged = uuid.uuid4().hex
            self._write(rows, merged)
            new |= {d: (merged, n) for d, n in self._written(rows.schema, merged).groupBy("day").agg(sizes).collect()}
            self._commit(batch, rows.schema, new)
            for day in old:  # no state names these files
                remove(self.spark, f"{self.path}/data/{name}/day={day}")
        else:
            self._commit(batch, _both(self._last()[1] or T.StructType(), df.schema), new)
        return True

    def _write(self, rows: DataFrame, name: str) -> None:
        # windows lie on a grid, so a day is a bounded number of rows
        dated = rows.withColumn("day", F.to_date("window_start")).repartition("day")
        dated.write.partitionBy("day").parquet(f"{self.path}/data/{name}")

    def _written(self, schema: T.StructType, name: str) -> DataFrame:
        dated = T.StructType([*schema, T.StructField("day", T.DateType())])
        return self.spark.read.schema(dated).parquet(f"{self.path}/data/{name}")

    def read(self, start: Column | None = None, end: Column | None = None) -> DataFrame:
        """Stored windows within an optional range; other days' files are not opened."""
        days = self.live(
            None if start is None else F.to_date(start), None if end is None else F.to_date(end)
        ).select("day", "files")
        schema = self._last()[1]
        if schema is None:
            raise ValueError(f"nothing was stored in {self.path}")
        rows = self._read(schema, dict(map(tuple, days.collect())))
        if start is not None:
            rows = rows.filter(F.col("window_start") >= start)
        return rows if end is None else rows.filter(F.col("window_end") <= end)

    # ---- retention ----

    def retain(self, n: int) -> list[date]:
        """Drop the days that hold none of the newest ``n`` windows; the days dropped. Files go with ``vacuum``."""
        newer = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
        counted = self.live().withColumn("newer", F.coalesce(F.sum("n_windows").over(newer), F.lit(0)))  # a row per day
        gone = sorted(r["day"] for r in counted.filter(F.col("newer") >= n).select("day").collect())
        if gone:
            seq, schema = self._last()
            self._commit(f"retain-{seq + 1}", schema, {d: (None, 0) for d in gone})
        return gone

    def vacuum(self, commits: int = 10) -> int:
        """Remove the files that no state of the last ``commits`` commits reads; how many folders went."""
        until = F.lead("seq").over(Window.partitionBy("day").orderBy("seq"))
        entries = self.log().filter("day is not null").withColumn("until", until)
        needed = F.col("until").isNull() | (F.col("until") > self._last()[0] - commits)
        kept = {f"{f}/day={d}" for d, f in entries.filter(needed & F.col("files").isNotNull()).select("day", "files").collect()}
        found = list_paths(self.spark, f"{self.path}/data/*/day=*")
        gone = [p for p in found if "/".join(p.split("/")[-2:]) not in kept]
        for p in gone:
            remove(self.spark, p)
        return len(gone)


def store(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Merge window rows into the store at ``path``; a batch without an id counts as a new one."""
    WindowStore(df.sparkSession, path).merge(df, batch or uuid.uuid4().hex)


def store_sink(path: str, name: str = "batch"):
    """A micro-batch sink that merges each batch into a store, once."""
    return lambda batch, batch_id: store(batch, path, f"{name}-{batch_id}")


def read_windows(spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Stored windows within an optional range."""
    return WindowStore(spark, path).read(start, end)


def columnar(stats: DataFrame) -> DataFrame:
    """Window scalars under their exchange names and types."""
    return stats.select(
        "window_start",
        "window_end",
        F.col("total_articles").cast("int").alias("total_articles"),
        F.col("rate_per_sec").alias("publishing_rate"),
        "avg_title_length",
        F.col("avg_description_length").alias("avg_desc_length"),
    )


def columnar_by_source(stats: DataFrame, source_counts: DataFrame) -> DataFrame:
    """One row per window and source, the window scalars repeated."""
    counts = source_counts.select(
        "window_start", "window_end", F.col("key").alias("source"), F.col("n").cast("int").alias("source_count")
    )
    return columnar(stats).join(counts, ["window_start", "window_end"])


def columnar_from_view(view: DataFrame) -> DataFrame:
    """As ``columnar_by_source``, from rows that carry their per-source map."""
    scalars = columnar(view).columns
    rows = view.select("*", F.explode("articles_per_source").alias("source", "source_count"))
    return (
        rows.withColumns(
            {
                "total_articles": F.col("total_articles").cast("int"),
                "publishing_rate": F.col("rate_per_sec"),
                "avg_desc_length": F.col("avg_description_length"),
                "source_count": F.col("source_count").cast("int"),
            }
        ).select(*scalars, "source", "source_count")
    )
