"""Attempts before the first success, per problem and per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import HOT_ROWS, row_numbers
from tallyloom.session import broadcast_if_small, saved

# The verdicts that count, the first of them meaning success.
VERDICTS = ("OK", "WRONG_ANSWER", "TIME_LIMIT_EXCEEDED", "MEMORY_LIMIT_EXCEEDED",
            "RUNTIME_ERROR", "COMPILATION_ERROR")
MIN_SOLVED = 10
TOP_N = 20


def relevant(df: DataFrame, verdict: str = "verdict", verdicts: Sequence[str] = VERDICTS) -> DataFrame:
    """Rows with a verdict that counts, marked 1 for success and 0 for failure."""
    kept = df.where(F.col(verdict).isin(*verdicts))
    return kept.withColumn("is_accepted", F.when(F.col(verdict) == verdicts[0], 1).otherwise(0))


def attempt_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with the running number of the attempt among its keys."""
    return row_numbers(df, keys, order, "attempt", hot_rows)


def failures_before_success(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Solved keys with the number of failures before their first success.

    The first success is an aggregate, so no group is ever sorted; the rows
    then meet it in a join that splits a skewed key: the sums go by a struct of
    the keys, so they are combined before an exchange of their own and the join
    need not keep a key together.
    """
    at = F.struct(*order)
    firsts = df.where(F.col("is_accepted") == 1).groupBy(*keys).agg(F.min(at).alias("_first"))
    firsts = broadcast_if_small(saved(firsts, "first-success"))
    early = F.when((F.col("is_accepted") == 0) & (at < F.col("_first")), 1).otherwise(0)
    met = df.join(firsts, list(keys)).groupBy(F.struct(*keys).alias("_k")).agg(F.sum(early).alias("failed_attempts"))
    return met.select("_k.*", "failed_attempts")


def hardest(solved: DataFrame, problem: Sequence[str], min_solved: int = MIN_SOLVED,
            top_n: int | None = TOP_N) -> DataFrame:
    """Problems by mean failures before success, hardest first."""
    stats = solved.groupBy(*problem).agg(
        F.avg("failed_attempts").alias("avg_failed_attempts"),
        F.count(F.lit(1)).alias("solved_by_count"),
    ).where(F.col("solved_by_count") >= min_solved)
    ordered = stats.orderBy(F.col("avg_failed_attempts").desc(), *problem)
    return ordered if top_n is None else ordered.limit(top_n)


def attempts_before_success(df: DataFrame, problem: Sequence[str], entity: str, order: Sequence[str],
                            verdict: str = "verdict", min_solved: int = MIN_SOLVED,
                            top_n: int | None = TOP_N) -> DataFrame:
    rows = relevant(df.select(*problem, entity, *order, verdict), verdict)
    return hardest(failures_before_success(rows, [*problem, entity], order), problem, min_solved, top_n)


def stage_row_counts(df: DataFrame, problem: Sequence[str], entity: str, order: Sequence[str],
                     verdict: str = "verdict", verdicts: Sequence[str] = VERDICTS,
                     min_solved: int = MIN_SOLVED) -> DataFrame:
    """stage, rows: how many rows each stage of the job passes on.

    All stages come from one aggregate per (problem, entity), instead of one
    run of the job per stage; a retried task cannot count anything twice.
    """
    keys = [*problem, entity]
    at, counts_in = F.struct(*order), F.col(verdict).isin(*verdicts)
    firsts = df.where(F.col(verdict) == verdicts[0]).groupBy(*keys).agg(F.min(at).alias("_first"))
    firsts = broadcast_if_small(saved(firsts, "first-success"))

    def flag(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    # By a struct, as in failures_before_success: a hot key is split in the join.
    per_key = df.join(firsts, keys, "left").groupBy(F.struct(*keys).alias("_k")).agg(
        F.count(F.lit(1)).alias("n_read"),
        flag(counts_in).alias("n_relevant"),
        flag(counts_in & (F.col("_first").isNull() | (at < F.col("_first")))).alias("n_before"),
        F.max(F.when(F.col("_first").isNotNull(), 1).otherwise(0)).alias("is_solved"),
    ).select("_k.*", "n_read", "n_relevant", "n_before", "is_solved")
    per_problem = per_key.groupBy(*problem).agg(
        F.sum("n_read").alias("n_read"), F.sum("n_relevant").alias("n_relevant"),
        F.sum("n_before").alias("n_before"), F.sum("is_solved").alias("n_solved"),
    )

    one = per_problem.agg(
        F.sum("n_read").alias("read"), F.sum("n_relevant").alias("relevant"),
        F.sum("n_solved").alias("first_success"), F.sum("n_before").alias("before_success"),
        flag(F.col("n_solved") > 0).alias("problems_solved"),
        flag(F.col("n_solved") >= min_solved).alias("problems_kept"),
    )
    pairs = ", ".join(f"'{c}', {c}" for c in one.columns)
    return one.select(F.expr(f"stack({len(one.columns)}, {pairs}) AS (stage, rows)"))
