"""State machines over ordered events, one for each key: a circuit breaker and a cooldown."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig


def _fold(events: DataFrame, key: str, zero: Column, step) -> DataFrame:
    """events: key, event_id, ts (double, seconds), failed. One row an event with the state that step leaves."""
    rows = events.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "failed"))).alias("rows"))
    start = F.struct(zero.alias("state"), F.array().cast("array<struct<event_id:bigint,state:string,allowed:boolean>>").alias("out"))

    def run(acc, row):
        state, allowed = step(acc["state"], row)
        said = F.struct(row["event_id"].alias("event_id"), state["name"].alias("state"), allowed.alias("allowed"))
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(said)).alias("out"))

    return rows.select(key, F.inline(F.aggregate("rows", start, run, lambda acc: acc["out"])))


def circuit_breaker(events: DataFrame, key: str, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """CLOSED until so many failures in a row; OPEN blocks until the timeout has passed; then HALF_OPEN tries one event.

    State is that after the event; a blocked event counts neither as success nor as failure.
    """
    none = F.lit(None).cast("double")
    zero = F.struct(F.lit("CLOSED").alias("name"), F.lit(0).alias("failures"), none.alias("last"))

    def step(state, e):
        passed = (state["name"] == "OPEN") & (e["ts"] - state["last"] > cfg.breaker_seconds)
        allowed = F.coalesce((state["name"] != "OPEN") | passed, F.lit(False))
        before = F.when(F.coalesce(passed, F.lit(False)), "HALF_OPEN").otherwise(state["name"])
        failures = state["failures"] + 1
        failed = F.when((before == "HALF_OPEN") | (failures >= cfg.breaker_failures), "OPEN").otherwise(before)
        name = F.when(~allowed, state["name"]).when(e["failed"], failed).otherwise(F.when(before == "HALF_OPEN", "CLOSED").otherwise(before))
        count = F.when(~allowed, state["failures"]).when(e["failed"], failures).otherwise(0)
        last = F.when(allowed & e["failed"], e["ts"]).otherwise(state["last"])
        return F.struct(name.alias("name"), count.alias("failures"), last.alias("last")), allowed

    return _fold(events, key, zero, step)


def cooldown(events: DataFrame, key: str, streak: int = 3, seconds: int = 600) -> DataFrame:
    """After so many failures in a row an engine rests: events are turned away until the time has passed."""
    zero = F.struct(F.lit("READY").alias("name"), F.lit(0).alias("failures"), F.lit(0.0).alias("until"))

    def step(state, e):
        allowed = e["ts"] >= state["until"]
        failures = F.when(e["failed"], state["failures"] + 1).otherwise(0)
        rests = allowed & (failures >= streak)
        until = F.when(rests, e["ts"] + seconds).otherwise(state["until"])
        count = F.when(~allowed, state["failures"]).when(rests, 0).otherwise(failures)
        name = F.when(rests | ~allowed, "RESTING").otherwise("READY")
        return F.struct(name.alias("name"), count.alias("failures"), until.alias("until")), allowed

    return _fold(events, key, zero, step)
