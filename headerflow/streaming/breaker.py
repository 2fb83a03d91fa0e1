"""The circuit breaker as a stateful stream: one state a key, kept between batches."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import SHIPPED, HeaderConfig


def breaker_stream(events: DataFrame, key: str, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """events: key (long), event_id, ts (seconds), failed. Rows as the batch operator gives, in the order of each batch."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, failures, last = state.get if state.exists else ("CLOSED", 0, -1.0)
        rows, out = pd.concat(list(frames)).sort_values(["ts", "event_id"]), []
        for r in rows.itertuples():
            if name == "OPEN" and r.ts - last > cfg.breaker_seconds:
                name = "HALF_OPEN"
            allowed = name != "OPEN"
            if allowed and r.failed:
                failures, last = failures + 1, float(r.ts)
                name = "OPEN" if name == "HALF_OPEN" or failures >= cfg.breaker_failures else name
            elif allowed:
                name, failures = ("CLOSED" if name == "HALF_OPEN" else name), 0
            out.append((k[0], r.event_id, name, allowed))
        state.update((name, failures, last))
        yield pd.DataFrame(out, columns=[key, "event_id", "state", "allowed"])

    return events.groupBy(key).applyInPandasWithState(run, f"{key} long, event_id long, state string, allowed boolean", "name string, failures int, last double", "append", GroupStateTimeout.NoTimeout)
