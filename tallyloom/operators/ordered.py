"""Order-dependent work inside groups, with very large groups spread over tasks.

A window partitioned by a key sorts each group in one task. That is what one
wants while groups are of ordinary size, and it is what ``OrderedRows`` does
for them. Groups above ``hot_rows`` rows are cut into contiguous slices of
their sort order (range partitioning on key and order columns), worked on
slice by slice, and stitched with one small row of carry per slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import broadcast_if_small, saved

# Rows of one group that a single task may sort.
HOT_ROWS = 5_000_000

_SLICE = "_slice"


def attach_by_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a one-row-per-key frame, keys compared null-safe."""
    renamed = per_key.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[c for c in per_key.columns if c not in keys],
    )
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, cond, "left").drop(*[f"_k_{k}" for k in keys])


class OrderedRows:
    """Rows of ``df`` in the order of ``order`` within each group of ``keys``.

    ``order`` must identify a row within its group, so that results do not
    depend on the run. Every method returns a new object with one more column;
    ``rows()`` gives the plain frame.
    """

    def __init__(self, plain: DataFrame, hot: DataFrame | None, keys: list[str], order: list[str]):
        self.plain, self.hot, self.keys, self.order = plain, hot, keys, order

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str],
           hot_rows: int = HOT_ROWS) -> OrderedRows:
        keys, order = list(keys), list(order)
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
        hot_total = sizes.agg(F.sum("_rows")).first()[0]
        if hot_total is None:
            return cls(df, None, keys, order)
        sizes = saved(sizes, "hot-groups")
        slices = 2 * math.ceil(hot_total / hot_rows)
        if keys:
            marks = broadcast_if_small(sizes.select(*keys, F.lit(True).alias("_hot")))
            marked = attach_by_key(df, marks, keys)
            plain = marked.where(F.col("_hot").isNull()).drop("_hot")
            big = marked.where(F.col("_hot")).drop("_hot")
        else:
            plain, big = df.limit(0), df
        ranged = big.repartitionByRange(slices, *keys, *order).withColumn(_SLICE, F.spark_partition_id())
        # Range bounds are sampled: fix the slice numbers before using them twice.
        return cls(plain, saved(ranged, "slices"), keys, order)

    def _window(self, hot: bool) -> Window:
        parts = [*self.keys, _SLICE] if hot else self.keys
        return Window.partitionBy(*parts).orderBy(*self.order)

    def _with(self, plain: DataFrame, hot: DataFrame | None) -> OrderedRows:
        return OrderedRows(plain, hot, self.keys, self.order)

    def _carried(self, summary: Column, combine: Callable[[Column], Column]) -> DataFrame:
        """Per (keys, slice): ``combine`` over the summaries of the earlier slices."""
        per_slice = self.hot.groupBy(*self.keys, _SLICE).agg(summary.alias("_summary"))
        earlier = (Window.partitionBy(*self.keys).orderBy(_SLICE)
                   .rowsBetween(Window.unboundedPreceding, -1))
        carry = per_slice.withColumn("_carry", combine(F.col("_summary")).over(earlier)).drop("_summary")
        return broadcast_if_small(saved(carry, "carry"))

    def with_column(self, name: str, value: Column) -> OrderedRows:
        return self._with(
            self.plain.withColumn(name, value),
            None if self.hot is None else self.hot.withColumn(name, value),
        )

    def running_sum(self, value: Column, name: str) -> OrderedRows:
        """Sum of ``value`` from the first row of the group to this one."""
        local = [F.sum(value).over(self._window(h).rowsBetween(Window.unboundedPreceding, 0))
                 for h in (False, True)]
        plain = self.plain.withColumn(name, local[0])
        if self.hot is None:
            return self._with(plain, None)
        carry = self._carried(F.sum(value), F.sum)
        hot = attach_by_key(self.hot.withColumn(name, local[1]), carry, [*self.keys, _SLICE])
        hot = hot.withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0))).drop("_carry")
        return self._with(plain, saved(hot, "running-sum"))

    def position(self, name: str = "pos") -> OrderedRows:
        """1-based row number in the group."""
        return self.running_sum(F.lit(1).cast("bigint"), name)

    def last_known(self, column: str, name: str, before: bool = False) -> OrderedRows:
        """Latest non-null value up to this row, or strictly before it."""
        stop = -1 if before else 0
        local = [F.last(column, ignorenulls=True).over(
            self._window(h).rowsBetween(Window.unboundedPreceding, stop)) for h in (False, True)]
        plain = self.plain.withColumn(name, local[0])
        if self.hot is None:
            return self._with(plain, None)
        newest = F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*self.order)))
        carry = self._carried(newest, lambda c: F.last(c, ignorenulls=True))
        hot = attach_by_key(self.hot.withColumn(name, local[1]), carry, [*self.keys, _SLICE])
        hot = hot.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")
        return self._with(plain, saved(hot, "last-known"))

    def lag(self, column: str, offset: int, name: str) -> OrderedRows:
        """The value ``offset`` rows earlier in the group, else null."""
        plain = self.plain.withColumn(name, F.lag(column, offset).over(self._window(False)))
        if self.hot is None:
            return self._with(plain, None)
        # Joining on (keys, position) spreads even a single group evenly.
        numbered = self._with(self.plain, self.hot).position("_pos").hot
        earlier = numbered.select(*self.keys, (F.col("_pos") + offset).alias("_pos"),
                                  F.col(column).alias(name))
        hot = attach_by_key(numbered, earlier, [*self.keys, "_pos"]).drop("_pos")
        return self._with(plain, saved(hot, "lag"))

    def rows(self) -> DataFrame:
        if self.hot is None:
            return self.plain
        return self.plain.unionByName(self.hot.drop(_SLICE))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with the 1-based position of each row in its group."""
    return OrderedRows.of(df, keys, order, hot_rows).position(name).rows()


def run_lengths(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs of consecutive equal values: keys, run (1, 2, ..), value, n."""
    ordered = OrderedRows.of(df.select(*keys, *order, value), keys, order, hot_rows)
    # A marker tells a null value from the missing row before the first one.
    ordered = ordered.with_column("_boxed", F.struct(F.col(value).alias("v")))
    ordered = ordered.lag("_boxed", 1, "_previous")
    starts = F.when(F.col("_previous").isNull() | ~F.col("_previous.v").eqNullSafe(F.col(value)), 1)
    runs = ordered.with_column("_start", F.coalesce(starts, F.lit(0)).cast("bigint"))
    runs = runs.running_sum(F.col("_start"), "run").rows()
    return runs.groupBy(*keys, "run", value).agg(F.count(F.lit(1)).alias("n"))


def grouped_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column,
                  max_items: int = 10_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Items of each group as ordered arrays: keys, part, items.

    A group of at most ``max_items`` rows gives one array (part 0). A larger
    one continues in parts 1, 2, .. of the same size, so that no row grows
    without bound and no item is left out.
    """
    numbered = row_numbers(df.withColumn("_item", item), keys, order, "_pos", hot_rows)
    part = F.floor((F.col("_pos") - 1) / max_items).alias("part")
    pairs = F.array_sort(F.collect_list(F.struct("_pos", "_item")))
    return (numbered.groupBy(*keys, part).agg(pairs.alias("_pairs"))
            .select(*keys, "part", F.transform("_pairs", lambda p: p["_item"]).alias("items")))
