"""Micro-batch sinks. A batch is written under its number, so a retried batch replaces itself."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from broadsheet.config import StreamSpec

log = logging.getLogger(__name__)

BatchFn = Callable[[DataFrame, int], None]


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def json_sink(path: str) -> BatchFn:
    """Keep each batch as JSON."""
    return lambda batch, batch_id: batch.write.mode("overwrite").json(batch_path(path, batch_id))


def parquet_sink(path: str) -> BatchFn:
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(batch_path(path, batch_id))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def jdbc_sink(url: str, table: str, **options) -> BatchFn:
    """Append each batch to a database table, its number in column ``batch_id``.

    The table should be unique on its window and ``batch_id``, so that a retried
    batch cannot be stored twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("append").format("jdbc").options(url=url, dbtable=table, **options).save()

    return write


def publish_each(batch: DataFrame, send: Callable[[dict], None]) -> DataFrame:
    """Send rows one by one from the tasks that hold them; one outcome row each."""

    def attempt(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            errors = []
            for row in part.to_dict("records"):
                try:
                    send(row)
                    errors.append(None)
                except Exception as e:  # a refused row is an outcome, not a failure of the task
                    errors.append(str(e))
            yield pd.DataFrame({"link": part["link"], "delivered": [e is None for e in errors], "error": errors})

    return batch.mapInPandas(attempt, "link string, delivered boolean, error string")


def delivery(
    publish: Callable[[DataFrame], None] | None,
    store: BatchFn,
    outcomes: str,
    send: Callable[[dict], None] | None = None,
    backup: bool = True,
) -> BatchFn:
    """Publish a batch as a whole, else row by row; store what was refused, or all of it as a backup.

    Outcomes of row-by-row sending are written before they are counted, so
    counting does not send again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            refused = batch
            if publish is not None:
                try:
                    publish(batch)
                    refused = None
                except Exception as e:
                    log.warning("batch %s was refused: %s", batch_id, e)
                    if send is not None:
                        path = batch_path(outcomes, batch_id)
                        publish_each(batch, send).write.mode("overwrite").parquet(path)
                        sent = batch.sparkSession.read.parquet(path)
                        links = sent.filter("not delivered").select(F.col("link").alias("_link")).distinct()
                        # a link sent twice with one refusal is kept whole: nothing refused is lost
                        refused = batch.join(links, F.col("link").eqNullSafe(F.col("_link")), "left_semi")
            if backup:
                store(batch, batch_id)
            elif refused is not None and not refused.isEmpty():
                store(refused, batch_id)
        finally:
            batch.unpersist()

    return run


def callback(fn: BatchFn) -> BatchFn:
    """A user function whose failure is logged and does not hold up the stream."""

    def run(batch: DataFrame, batch_id: int) -> None:
        try:
            fn(batch, batch_id)
        except Exception as e:
            log.warning("window callback failed on batch %s: %s", batch_id, e)

    return run


def fan_out(*sinks: BatchFn) -> BatchFn:
    """Give every batch to every sink; the batch is retried as a whole when one fails."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def start(
    df: DataFrame, sink: BatchFn, checkpoint: str, stream: StreamSpec = StreamSpec(), mode: str = "append"
) -> StreamingQuery:
    """Run a sink on every micro-batch; offsets are committed after the sink returns."""
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**stream.trigger)
        .start()
    )


def _add(total: dict[str, dict[str, int]], p: dict) -> None:
    total["query"]["batches"] += 1
    total["query"]["input_rows"] += p["numInputRows"]
    for op in p["stateOperators"]:
        total["query"]["dropped_late"] += op["numRowsDroppedByWatermark"]
    for name, row in p["observedMetrics"].items():
        into = total.setdefault(name, {})
        values = row.asDict() if hasattr(row, "asDict") else dict(row)
        for k, v in values.items():
            into[k] = into.get(k, 0) + (v or 0)


def _zero() -> dict[str, dict[str, int]]:
    return {"query": {"batches": 0, "input_rows": 0, "dropped_late": 0}}


def counters(query: StreamingQuery) -> dict[str, dict[str, int]]:
    """Sums of the observed counters and of rows in and dropped, over the batches the query still remembers.

    A query forgets all but its last progress reports; ``Totals`` counts every batch.
    """
    total = _zero()
    for p in query.recentProgress:
        _add(total, p)
    return total


class Totals(StreamingQueryListener):
    """Counters over all batches of every query that runs while this listens.

    ``spark.streams.addListener(totals)`` before the query starts; then ``totals.of(query)``.
    """

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, dict[str, int]]] = {}

    def of(self, query: StreamingQuery) -> dict[str, dict[str, int]]:
        return self.totals.get(str(query.id), _zero())

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), _zero())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        report = {
            "numInputRows": p.numInputRows,
            "stateOperators": [{"numRowsDroppedByWatermark": s.numRowsDroppedByWatermark} for s in p.stateOperators],
            "observedMetrics": p.observedMetrics,
        }
        _add(self.totals.setdefault(str(p.id), _zero()), report)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
