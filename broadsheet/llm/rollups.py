"""Token totals by source, language and tokenizer version, maintained by deltas.

A batch of changes becomes one table of signed sums per key: an insert adds a
document and its tokens, a delete takes both away, a revision takes the old
tokens and adds the new ones, moving them between keys where source or language
changed. Sums are additive, so a batch is combined on the map side (a hot source
is one row per task) and totals are the sum over the batches.

A batch is committed under its id, in a folder of its own that a commit replaces
as a whole. Committing the same batch again, after a lost driver or a repeated
delivery, leaves the totals as they are; batches may arrive in any order.
``compact`` folds committed batches into one base and remembers their ids.

Changes: ``op`` (insert, delete, revise), ``source, lang, version, n_tokens``, and
for a revision the former ``old_source, old_lang, old_tokens``. Defined cases: a
null source or language is a value of its own; null tokens count as 0; an
unknown or null ``op`` fails the batch; repeated rows are repeated changes; an
empty batch is committed and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["source", "lang", "version"]
SUMS = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType())]
)


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per key: ``source, lang, version, docs, tokens``."""
    n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))

    def part(source, lang, docs, tokens):
        return F.struct(
            source.alias("source"), lang.alias("lang"), F.lit(docs).cast("long").alias("docs"), tokens.cast("long").alias("tokens")
        )

    now, then = (F.col("source"), F.col("lang")), (F.col("old_source"), F.col("old_lang"))
    parts = (
        F.when(F.col("op") == "insert", F.array(part(*now, 1, n)))
        .when(F.col("op") == "delete", F.array(part(*now, -1, -n)))
        .when(F.col("op") == "revise", F.array(part(*then, -1, -old), part(*now, 1, n)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))))
    )
    rows = changes.select("version", F.explode(parts).alias("p")).select("version", "p.*")
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Totals kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        path, fs = self._path(kind)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Add a batch, or replace it by itself. A batch that ``compact`` has folded in is left alone."""
        if batch not in self._folded():
            deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch}")

    def batches(self) -> list[str]:
        """Committed batches that no base holds yet; one without its success mark is not committed."""
        folded = self._folded()
        found = []
        for name in self._names("batches"):
            path, fs = self._path(f"batches/{name}/_SUCCESS")
            if name not in folded and fs.exists(path):
                found.append(name)
        return sorted(found)

    def _base(self) -> str | None:
        done = [n for n in self._names("bases") if "_SUCCESS" in self._names(f"bases/{n}/members")]
        return max(done, key=int, default=None)

    def _folded(self) -> set[str]:
        base = self._base()
        if base is None:
            return set()
        return {r[0] for r in self.spark.read.schema("batch string").parquet(f"{self.folder}/bases/{base}/members").collect()}

    def _sums(self) -> DataFrame:
        base = self._base()
        paths = [f"{self.folder}/batches/{b}" for b in self.batches()]
        paths += [f"{self.folder}/bases/{base}/sums"] if base is not None else []
        if not paths:
            return self.spark.createDataFrame([], SUMS)
        return self.spark.read.schema(SUMS).parquet(*paths)

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens`` of all keys that still have documents or tokens."""
        sums = self._sums().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs != 0 or tokens != 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base; their names stay known."""
        names = sorted(self._folded() | set(self.batches()))
        number = str(int(self._base() or "-1") + 1)
        self.totals().write.mode("overwrite").parquet(f"{self.folder}/bases/{number}/sums")
        members = self.spark.createDataFrame([(n,) for n in names], "batch string")
        # written last: a base without its members is not used
        members.write.mode("overwrite").parquet(f"{self.folder}/bases/{number}/members")
