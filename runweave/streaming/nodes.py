"""Node states as a stream with an end: the last write of each node, and a closing row once it is silent.

A keyed function with state keeps one row a node and a timeout for the event time at which the node counts as
silent. The timeout sends a closing row and clears the state, so state follows the nodes that are alive, not all ever
seen. Rows are folded by key where they are read first, so that a hot node costs a row a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEYS = ["run_id", "id"]
#: Keys that a task folds at a time.
FOLDED = 100_000


def _newest(frame: pd.DataFrame) -> pd.DataFrame:
    """One row a node: the newest by ``ts``, then ``seq``."""
    return frame.sort_values(["ts", "seq"], kind="stable").drop_duplicates(KEYS, keep="last")


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None
    for frame in frames:
        held = _newest(frame if held is None else pd.concat([held, frame], ignore_index=True))
        if len(held) >= FOLDED:
            yield held
            held = None
    if held is not None:
        yield held


def _millis(ts: Any) -> int:
    return pd.Timestamp(ts).value // 1_000_000


def _step(names: Sequence[str], silence: int, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState):
    """One node in one batch: keep its newest row, or, once its time is up, send it closed and forget it."""
    closed = state.hasTimedOut
    best = list(state.get) if state.exists else None
    for frame in frames:
        if frame.empty:  # as when a timeout calls
            continue
        newest = (frame if len(frame) == 1 else _newest(frame))[names].values.tolist()[0]
        new = [None if pd.isna(v) else v for v in newest]
        if best is None or (pd.Timestamp(best[0]), best[1]) < (pd.Timestamp(new[0]), new[1]):
            best = new
    if not closed:
        ends = _millis(best[0]) + silence
        closed = ends <= state.getCurrentWatermarkMs()  # already silent when its last row came
    if closed:
        if state.exists:
            state.remove()
    else:
        state.update((pd.Timestamp(best[0]).to_pydatetime(), *best[1:]))
        state.setTimeoutTimestamp(ends)
    row = {**dict(zip(KEYS, key)), **dict(zip(names, best)), "closed": closed}
    del row["seq"]
    yield pd.DataFrame([row])


def closing_nodes_stream(
    updates: DataFrame, value_columns: Sequence[str], silence_seconds: int = 3600, delay: str = "1 hour"
) -> DataFrame:
    """``(run_id, id, ts, values, closed)`` of every node that a batch changes, or that falls silent.

    ``updates``: run_id, id, ts, seq and the values. A row is the node's newest write by ``ts``, then ``seq``. A
    node is closed once the watermark, ``delay`` behind the newest time seen, has passed its last write by
    ``silence_seconds``; a later write opens it again. Rows older than the watermark are dropped. For update
    mode; a batch has one row a node.
    """
    updates = updates.select(*KEYS, "ts", "seq", *value_columns)
    fields = {f.name: f for f in updates.schema.fields}
    state = T.StructType([T.StructField(n, fields[n].dataType) for n in ("ts", "seq", *value_columns)])
    out = [T.StructField(n, fields[n].dataType) for n in (*KEYS, "ts", *value_columns)]
    folded = updates.mapInPandas(_fold, updates.schema).withWatermark("ts", delay)
    return folded.groupBy(*KEYS).applyInPandasWithState(
        partial(_step, state.names, silence_seconds * 1000),
        T.StructType([*out, T.StructField("closed", T.BooleanType())]),
        state,
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )
