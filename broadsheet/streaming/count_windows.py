"""Windows of a fixed number of rows per key on a stream, with state per key.

State is a running count, sums and times, so it does not grow with the window.
A hot source is spread over several tasks by adding a shard column, such as the
broker partition, to the keys: windows are then counted per source and shard,
as they are when several collectors each count their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "window_no long, n long, title long, description long, first_us long, last_us long"
_OUT = (
    "window_no long, total_articles long, avg_title_length double, avg_description_length double, "
    "first_article_at timestamp, last_article_at timestamp, closed boolean"
)
_EMPTY = (0, 0, 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min)


def _row(key: tuple, window_no: int, n: int, title: int, description: int, first: int, last: int, size: int) -> tuple:
    when = [pd.Timestamp(us, unit="us") for us in (first, last)]
    return (*key, window_no, n, title / n, description / n, *when, n == size)


def count_windows(
    articles: DataFrame, size: int, keys: list[str], length_unit: str = "bytes", idle_ms: int | None = None
) -> DataFrame:
    """Emit a row whenever a key has collected ``size`` rows, in order of arrival.

    With ``idle_ms`` a key that stays silent that long emits its unfilled window.
    """
    length = F.octet_length if length_unit == "bytes" else F.length
    rows = articles.select(
        *keys,
        F.unix_micros("ts").alias("us"),
        F.coalesce(length("title").cast("long"), F.lit(0)).alias("title"),
        F.coalesce(length("description").cast("long"), F.lit(0)).alias("description"),
    )
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    columns = [c.strip().split(" ")[0].strip("`") for c in f"{key_types}, {_OUT}".split(",")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, *held = state.get if state.exists else (0, *_EMPTY)
        if state.hasTimedOut:
            # the number is kept, so that later windows of the key do not repeat it
            state.update((number + (held[0] > 0), *_EMPTY))
            if held[0]:
                yield pd.DataFrame([_row(key, number, *held, size)], columns=columns)
            return
        for batch in batches:
            out = []
            us, title, text = (batch[c].to_numpy() for c in ("us", "title", "description"))
            at = 0
            while at < len(us):
                end = min(at + size - held[0], len(us))
                part = slice(at, end)
                held = [
                    held[0] + end - at,
                    held[1] + int(title[part].sum()),
                    held[2] + int(text[part].sum()),
                    min(held[3], int(us[part].min())),
                    max(held[4], int(us[part].max())),
                ]
                at = end
                if held[0] == size:
                    out.append(_row(key, number, *held, size))
                    number, held = number + 1, list(_EMPTY)
            yield pd.DataFrame(out, columns=columns)
        state.update((number, *held))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy(*keys).applyInPandasWithState(step, f"{key_types}, {_OUT}", _STATE, "append", timeout)
