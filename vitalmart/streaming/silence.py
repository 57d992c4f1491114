"""Keys that fall silent: alerts raised by a timer, not by an arriving row.

A stream's aggregates change only when rows arrive, so a source that stops sending looks as fresh as at its
last row. Here every key keeps its newest time and a timer in the state; when the watermark (moved by other keys
or by a heartbeat) passes the newest time by more than the limit, the key is reported, once per silence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BEAT = "\x00beat"  # the key that heartbeats are grouped under


def silences(df: DataFrame, key: str, ts: str, limit_seconds: int, lateness: str = "1 hour") -> DataFrame:
    """One row per silence of more than ``limit_seconds``: the key as text, ``silent_since`` (its newest row's time)
    and ``events_before`` (rows of the key up to then). For append mode.

    Rows of a key may arrive in any order within a batch and up to ``lateness`` late between batches; a late row
    inside a gap already reported does not take the report back. Rows without key or time are ignored.
    Rows with ``is_beat`` only move time. The state of a key is three numbers.
    """
    beat = F.col("is_beat") if "is_beat" in df.columns else F.lit(False)
    rows = df.where(F.col(ts).isNotNull() & (beat | F.col(key).isNotNull())).withWatermark(ts, lateness)
    rows = rows.select(F.when(beat, F.lit(BEAT)).otherwise(F.col(key).cast("string")).alias("key"), ts, F.unix_micros(ts).alias("micros"))
    limit = limit_seconds * 1_000_000

    def watch(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, seen, told = state.get if state.exists else (None, 0, False)
        found: list[tuple[int, int]] = []
        if state.hasTimedOut:
            found, told = [(newest, seen)], True
        else:
            times = np.sort(np.concatenate([b["micros"].to_numpy(np.int64) for b in batches]))
            known = times[times <= newest] if newest is not None else times[:0]
            seen += len(known)
            times = times[len(known):]
            if len(times):
                before = np.concatenate([[newest if newest is not None else times[0]], times[:-1]])
                gaps = np.flatnonzero(times - before > limit)
                found = [(int(before[i]), seen + int(i)) for i in gaps if i or not told]
                newest, seen, told = int(times[-1]), seen + len(times), False
        if group[0] == BEAT:
            return
        state.update((newest, seen, told))
        if not told:
            # milliseconds; the watermark has to be past the limit, never only at it
            state.setTimeoutTimestamp(max((newest + limit) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if found:
            yield pd.DataFrame({"key": [group[0]] * len(found), "silent_since": pd.to_datetime([t for t, _ in found], unit="us", utc=True),
                                "events_before": [c for _, c in found]})

    return rows.groupBy("key").applyInPandasWithState(
        watch, "key string, silent_since timestamp, events_before bigint", "newest bigint, seen bigint, told boolean", "append",
        GroupStateTimeout.EventTimeTimeout)
