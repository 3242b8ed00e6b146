"""Match counts per subject, averages per group, and tied best items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import HOT_ROWS, attach_by_key, grouped_lists
from tallyloom.session import broadcast_if_small, saved


def match_counts(roles: DataFrame, ratings: DataFrame, subject: str, on: Sequence[str],
                 flags: Mapping[str, Column]) -> DataFrame:
    """Per subject, how many rated rows match under each flag; none gives 0.

    As in a left join with an undeduplicated right side, a rating row that
    occurs twice counts twice. Null join keys match nothing. Ratings are added
    up per key first, so roles are joined once for all flags and no role row
    is ever multiplied; with few rated keys they are not even shuffled for it.
    """
    per_key = ratings.groupBy(*on).agg(
        *[F.sum(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()]
    )
    some = F.greatest(*[F.col(n) for n in flags], F.lit(0)) > 0
    per_key = broadcast_if_small(saved(per_key.where(some), "rated"))
    matched = roles.select(subject, *on).join(per_key, list(on), "left")
    return matched.groupBy(subject).agg(*[F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in flags])


def group_average(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias(name))


def best_items(df: DataFrame, keys: Sequence[str], item: str, value: str, tie_break: Sequence[str] = (),
               max_items: int = 10_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """keys, part, items, best, mean: every item that reaches the group's best value.

    Tied items are sorted; more than ``max_items`` of them continue in further parts.
    """
    rated = df.where(F.col(value).isNotNull()).select(*keys, item, value, *tie_break)
    stats = rated.groupBy(*keys).agg(F.max(value).alias("best"), F.avg(value).alias("mean"))
    stats = saved(stats, "group-stats")
    sized = broadcast_if_small(stats)
    tied = attach_by_key(rated, sized, keys).where(F.col(value) == F.col("best"))
    lists = grouped_lists(tied.select(*keys, item, *tie_break), keys, [item, *tie_break],
                          F.col(item), max_items, hot_rows)
    return attach_by_key(lists, sized, keys)
