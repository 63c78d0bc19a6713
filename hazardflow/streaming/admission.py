"""STRM-1: sliding-window admission per key (at most ``limit`` admitted per ``window`` seconds).

A request at time t first forgets admitted timestamps with ``t - s > window`` (a timestamp exactly
``window`` old still counts), then is admitted when fewer than ``limit`` remain; refused requests
do not count. The state per key is at most ``limit`` timestamps.

Batch twin: a key's requests split into independent sessions wherever the gap exceeds the window
(the state is empty there). Sessions are dealt over partitions and read in order, carrying at most
``limit`` timestamps, so memory is bounded however long a session is.

Stream: the state of a key times out by event time once the watermark has passed its last request by
the window. A late request (behind newer ones of its key that were judged in an earlier batch) is
judged against the state as it is: newer admitted requests count, none is judged again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.scan import bucketed_lead, prefix_scan


def _admit(ts: list[float], state: deque, window: float, limit: int) -> list[bool]:
    out = []
    for t in ts:
        while state and t - state[0] > window:
            state.popleft()
        if len(state) < limit:
            state.append(t)
            out.append(True)
        else:
            out.append(False)
    return out


def admit_batch(df: DataFrame, *, key_col: str = "user_id", ts_col: str = "ts", id_col: str = "event_id",
                window: float = 60.0, limit: int = 60) -> DataFrame:
    """Adds ``admitted boolean``; order within a key is (ts, id)."""
    from hazardflow.sources.cohorts import _micros_ntz

    secs = _micros_ntz(F.col(ts_col)).cast("double") / 1e6
    base = df.withColumn("_s", secs).withColumn("_neg", -F.col("_s")).withColumn("_nid", -F.col(id_col))
    prev = bucketed_lead(base, [key_col], "_neg", "_nid", {"_prev": "_s"})
    start = (F.col("_prev").isNull() | (F.col("_s") - F.col("_prev") > window)).cast("long")
    sess = prefix_scan(prev.withColumn("_start", start), [key_col], "_s", {"_session": "_start"})
    cols = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, kept = None, deque()  # the run of (key, session) that the last batch ended in, at most ``limit`` times
        for pdf in batches:
            flags = []
            for part, rows in pdf.groupby([key_col, "_session"], sort=False, dropna=False):
                part = tuple(None if pd.isna(x) else x for x in part)  # a NaN key would never equal itself
                if part != at:
                    at, kept = part, deque()
                flags.extend(_admit(rows["_s"].tolist(), kept, window, limit))
            yield pdf[cols].assign(admitted=flags)

    schema = df.select(*cols).schema.add("admitted", "boolean")
    ordered = sess.repartition(key_col, "_session").sortWithinPartitions(key_col, "_session", "_s", id_col)
    return ordered.select(*cols, "_s", "_session").mapInPandas(run, schema)


def admit_stream(stream: DataFrame, *, key_col: str = "user_id", ts_col: str = "ts",
                 id_col: str = "event_id", window: float = 60.0, limit: int = 60,
                 delay: str = "10 minutes") -> DataFrame:
    """Streaming version: ``applyInPandasWithState`` keeps the admitted timestamps per key.

    ``delay`` is how far the watermark stays behind the newest request.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    cols = [key_col, id_col, ts_col]
    out_schema = f"{key_col} long, {id_col} long, {ts_col} timestamp, admitted boolean"

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # no admitted request can count any more
            state.remove()
            return
        kept = deque(state.get[0]) if state.exists else deque()
        pdf = pd.concat(list(batches)).sort_values([ts_col, id_col], kind="mergesort")
        secs = (pd.to_datetime(pdf[ts_col]).astype("int64") / 1e9).tolist()
        adm = _admit(secs, kept, window, limit)
        state.update((list(kept),))
        forget = int((max([*secs, *kept]) + window) * 1000) + 1
        state.setTimeoutTimestamp(max(forget, state.getCurrentWatermarkMs() + 1))
        pdf = pdf[cols].assign(admitted=adm)
        yield pdf

    src = stream.select(F.col(key_col).cast("long").alias(key_col), F.col(id_col).cast("long"),
                        F.col(ts_col).cast("timestamp").alias(ts_col)).withWatermark(ts_col, delay)
    return src.groupBy(key_col).applyInPandasWithState(
        run, out_schema, "admitted array<double>", "append", GroupStateTimeout.EventTimeTimeout)
