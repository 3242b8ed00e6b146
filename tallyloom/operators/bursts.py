"""Burst detection: many records in little time, with two thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import HOT_ROWS, OrderedRows

# Records in the window, and the gaps (microseconds) that start and end an event.
BURST_SIZE = 50
START_GAP = 50 * 1_000_000
END_GAP = 100 * 1_000_000


def burst_changes(df: DataFrame, keys: Sequence[str], time: str, tie_break: str, size: int = BURST_SIZE,
                  start_gap: int = START_GAP, end_gap: int = END_GAP, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per START and END: keys, event_no, kind, time, tie_break, oldest, gap.

    ``time`` is a bigint column. The gap of a record reaches back to the record
    ``size - 1`` places earlier. An event starts when the gap is at most
    ``start_gap`` and ends when it is at least ``end_gap``; in between the state holds.
    """
    ordered = OrderedRows.of(df.select(*keys, time, tie_break), keys, [time, tie_break], hot_rows)
    ordered = ordered.lag(time, size - 1, "oldest").with_column("gap", F.col(time) - F.col("oldest"))
    signal = F.when(F.col("gap") <= start_gap, 1).when(F.col("gap") >= end_gap, 0)
    ordered = ordered.with_column("_signal", signal).last_known("_signal", "_was", before=True)
    was = F.coalesce("_was", F.lit(0))
    is_start = (was == 0) & F.coalesce(F.col("_signal") == 1, F.lit(False))
    is_end = (was == 1) & F.coalesce(F.col("_signal") == 0, F.lit(False))
    ordered = ordered.with_column("kind", F.when(is_start, "START").when(is_end, "END"))
    starts = F.when(F.col("kind") == "START", 1).otherwise(0).cast("bigint")
    changes = ordered.running_sum(starts, "event_no").rows().where(F.col("kind").isNotNull())
    return changes.select(*keys, "event_no", "kind", time, tie_break, "oldest", "gap")


def burst_episodes(changes: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """One row per event: when its first record came, when it was noticed, when it ended (or null)."""
    at = {k: F.max(F.when(F.col("kind") == k, F.col(time))) for k in ("START", "END")}
    return changes.groupBy(*keys, "event_no").agg(
        F.max(F.when(F.col("kind") == "START", F.col("oldest"))).alias("first_record"),
        at["START"].alias("noticed"),
        at["END"].alias("ended"),
    )
