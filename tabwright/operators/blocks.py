"""Operators over consecutive rows: fixed-size blocks in a named order.

A block is ``n`` consecutive rows. Rows carry their place either in ``position_col`` (an existing
dense 0-based number) or through ``order_col``, from which the place is computed. Windows are
partitioned by block, so a task never holds more than one block of a group at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.operators.ranking import with_position

BLOCK, PLACE = "_blk", "_pos"


def blocked(df: DataFrame, n_rows: int, position_col: str | None = None, order_col: str | None = None) -> DataFrame:
    """Adds the block number and the place inside the block."""
    if (position_col is None) == (order_col is None):
        raise ValueError("name either position_col or order_col")
    if position_col is None:
        df, position_col = with_position(df, order_col, name="_rn"), "_rn"
    # whole-number division: a double would lose places beyond 2**53
    out = df.withColumns({
        BLOCK: F.expr(f"`{position_col}` div {int(n_rows)}"),
        PLACE: (F.col(position_col) % F.lit(int(n_rows))).cast("int"),
    })
    return out.drop("_rn")


def _verdict(blocks: DataFrame, *extra: str) -> DataFrame:
    """One row from per-block ``is_null`` and ``is_bad``: the first bad block and what came before it."""
    first_bad = blocks.agg(F.min(F.when(F.col("is_bad"), F.col(BLOCK)))).scalar()
    return blocks.agg(
        F.min(F.when(F.col("is_bad"), F.col(BLOCK))).alias("first_bad_block"),
        *[F.min_by(F.when(F.col("is_bad"), F.col(c)), F.when(F.col("is_bad"), F.col(BLOCK))).alias(c) for c in extra],
        F.count_if(F.col("is_null") & (F.col(BLOCK) < F.coalesce(first_bad, F.lit(2**62)))).alias("n_null_blocks"),
    ).select(F.col("first_bad_block").isNull().alias("is_pattern"), "first_bad_block", *extra, "n_null_blocks")


def analyze_unique_values_pattern(df: DataFrame, column_name: str, n_rows_per_block: int = 8,
                                  n_unique_values_per_block: int = 1, *, position_col: str | None = None,
                                  order_col: str | None = None) -> DataFrame:
    """Does every block hold exactly k distinct values? Blocks without values are skipped and counted."""
    rows = blocked(df, n_rows_per_block, position_col, order_col)
    # a set per block is bounded by the block size and needs a single shuffle, unlike a distinct count
    per_block = rows.groupBy(BLOCK).agg(F.size(F.collect_set(column_name)).alias("n_unique"))
    return _verdict(per_block.select(
        BLOCK, "n_unique", (F.col("n_unique") == 0).alias("is_null"),
        (~F.col("n_unique").isin(0, n_unique_values_per_block)).alias("is_bad"),
    ), "n_unique")


def _literals(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def analyze_ordered_values_pattern(df: DataFrame, column_name: str, n_rows_per_block: int, ordered_sequence: Sequence,
                                   *, position_col: str | None = None, order_col: str | None = None) -> DataFrame:
    """Does every block follow the given sequence? Missing values match anything; a short last block is fine."""
    rows = blocked(df, n_rows_per_block, position_col, order_col)
    expected = F.try_element_at(_literals(ordered_sequence), F.col(PLACE) + 1)
    per_block = rows.groupBy(BLOCK).agg(
        (F.count(column_name) == 0).alias("is_null"),
        (F.count_if(F.col(column_name).isNotNull() & ~F.col(column_name).eqNullSafe(expected)) > 0).alias("is_bad"),
    )
    return _verdict(per_block)


def analyze_incremental_num_values_pattern(df: DataFrame, column_name: str, n_rows_per_block: int,
                                           step_size: float = 1 / 12, tolerance: float = 0.001, *,
                                           position_col: str | None = None, order_col: str | None = None) -> DataFrame:
    """Does every block grow by ``step_size`` per place, across gaps? One lone value cannot be judged."""
    rows = blocked(df, n_rows_per_block, position_col, order_col).select(
        BLOCK, PLACE, F.col(column_name).cast("double").alias("v")
    )
    order = Window.partitionBy(BLOCK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col("v").isNotNull(), F.struct("v", PLACE)), ignorenulls=True).over(order)
    gap = (F.col("v") - F.col("_before.v")) - F.lit(float(step_size)) * (F.col(PLACE) - F.col(f"_before.{PLACE}"))
    stepped = rows.withColumn("_before", before)
    per_block = stepped.groupBy(BLOCK).agg(
        F.count("v").alias("n"), F.count_if(F.abs(gap) > F.lit(float(tolerance))).alias("wrong"),
    )
    reason = F.when(F.col("n") == 1, F.lit("too_few_values")).when(F.col("wrong") > 0, F.lit("wrong_step"))
    return _verdict(per_block.select(
        BLOCK, (F.col("n") == 0).alias("is_null"), reason.alias("reason"), reason.isNotNull().alias("is_bad"),
    ), "reason")


METHODS = ("unique", "mean", "median", "mode")


def impute_missing_with_value_per_pattern(df: DataFrame, column_name: str, n_rows_per_pattern: int,
                                          method: str = "unique", *, position_col: str | None = None,
                                          order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fill gaps with the block's value. Returns the table and a one-row report.

    ``unique`` needs one distinct value per block; if some block has more, nothing is filled and
    the report names the first such block. Blocks without any value stay empty.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {list(METHODS)}")
    rows = blocked(df, n_rows_per_pattern, position_col, order_col)
    value, whole = F.col(column_name), Window.partitionBy(BLOCK)
    per_block = rows.groupBy(BLOCK).agg(
        (F.count(column_name) == 0).alias("is_null"),
        (F.min(column_name) != F.max(column_name)).alias("_mixed") if method == "unique" else F.lit(False).alias("_mixed"),
    ).withColumn("is_bad", F.coalesce("_mixed", F.lit(False)))
    report = _verdict(per_block).withColumnRenamed("is_pattern", "imputed").withColumn("method", F.lit(method))
    if method == "unique":
        fill = F.when(report.select("imputed").scalar(), F.max(value).over(whole))
    elif method == "mean":
        fill = F.avg(value).over(whole)
    elif method == "median":
        fill = F.median(value).over(whole)
    else:
        # most frequent value, the smallest one on a tie
        fill = F.mode(value, deterministic=True).over(whole)
    filled = rows.withColumn(column_name, F.coalesce(value, fill)).select(*df.columns)
    return filled, report


def impute_missing_with_ordered_values_per_pattern(df: DataFrame, column_name: str, n_rows_per_pattern: int,
                                                   ordered_values_to_impute: Sequence, *,
                                                   position_col: str | None = None,
                                                   order_col: str | None = None) -> DataFrame:
    """Fill gaps from a list by place in the block (no shuffle when the position is known)."""
    if ordered_values_to_impute is None or len(ordered_values_to_impute) != n_rows_per_pattern:
        raise ValueError(f"ordered_values_to_impute must hold {n_rows_per_pattern} values")
    rows = blocked(df, n_rows_per_pattern, position_col, order_col)
    value = F.coalesce(F.col(column_name), F.element_at(_literals(ordered_values_to_impute), F.col(PLACE) + 1))
    return rows.withColumn(column_name, value).select(*df.columns)


def impute_missing_with_incremental_value_per_pattern(df: DataFrame, column_name: str, n_rows_per_block: int,
                                                      step_size: float = 1 / 12, *, position_col: str | None = None,
                                                      order_col: str | None = None) -> DataFrame:
    """Continue the block's progression: from the value to the left, or back from the first value."""
    rows = blocked(df, n_rows_per_block, position_col, order_col)
    value, step = F.col(column_name).cast("double"), F.lit(float(step_size))
    order = Window.partitionBy(BLOCK).orderBy(PLACE)
    known = F.when(value.isNotNull(), F.struct(value.alias("v"), F.col(PLACE).alias("p")))
    anchored = rows.withColumns({
        "_left": F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "_right": F.first(known, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    filled = F.coalesce(
        value,
        F.col("_left.v") + (F.col(PLACE) - F.col("_left.p")) * step,
        F.col("_right.v") - (F.col("_right.p") - F.col(PLACE)) * step,
    )
    return anchored.withColumn(column_name, filled).select(*df.columns)
