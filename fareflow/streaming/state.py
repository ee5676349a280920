"""Keyed state with expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Keys that the rows of one running maximum are spread over.
PARTS = 16


def newest(df: DataFrame, ts: str, keep: str = "1 hour") -> DataFrame:
    """Rows that, when they came, had the highest ``ts`` so far or an equal one, within one of ``PARTS`` parts of the stream.

    State is one time for each part, however long the stream runs; a timer removes it when the stream's highest time
    is ``keep`` past it. Rows without a time, or that much behind, are left out. The rows at the highest time of all
    are among those given out. (A timer on the clock instead would make a run over what is available never end.)
    """
    columns = list(df.columns)

    def reach(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        high, found = state.get[0] if state.exists else None, []
        for frame in frames:
            top = int(frame["_at"].max())
            if high is None or top > high:
                high, found = top, []
            found.append(frame[frame["_at"] == high])
        state.update((high,))
        state.setTimeoutTimestamp(high // 1000 + 1)
        for frame in found:
            yield frame[columns]

    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).filter(F.col(ts).isNotNull()).withWatermark(ts, keep)
    spread = timed.withColumns({"_at": F.unix_micros(ts), "_part": F.pmod(F.xxhash64(*columns), F.lit(PARTS))})
    return spread.groupBy("_part").applyInPandasWithState(reach, timed.schema, "at long", "append", GroupStateTimeout.EventTimeTimeout)
