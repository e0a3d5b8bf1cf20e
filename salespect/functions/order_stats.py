"""Exact global ranks and quantiles without a single-task sort.

Ordering a whole table by one column would send every row to one task. Here
equal values are first counted together, the distinct values are range
partitioned, and only one total per range is combined in one place. Each range
is ordered by its own task and shifted by what lies above it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salespect.config import Settings
from salespect.functions.joins import join_spread
from salespect.functions.staging import staged

# Rank error of the sketch that brackets a quantile, as a share of the rows.
SKETCH_ACCURACY = 100_000


def ranked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values of numeric columns, each column in descending order.

    Gives column_name, value, n (rows with the value), dense_rank, rows_before
    (rows with a greater value) and total_rows. The counted values are written
    together with the number of their range, which fixes the ranges for all
    later reads and retries, and so are their ranks, which quantiles and rank
    joins read; calling this runs those two jobs.
    """
    counts = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = staged(
        counts.repartitionByRange("column_name", F.desc("value")).withColumn(
            "range", F.spark_partition_id()
        ),
        "value_counts",
    )
    key = ["column_name", "range"]
    column = Window.partitionBy("column_name")
    above = column.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))
        .select(
            *key,
            F.coalesce(F.sum("values").over(above), F.lit(0)).alias("values_above"),
            F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("rows_above"),
            F.sum("rows").over(column).alias("total_rows"),
        )
    )
    within = Window.partitionBy(*key).orderBy(F.desc("value"))
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    # One offset row per shuffle partition and column: safe to broadcast at any data size.
    ranked = ranged.join(F.broadcast(offsets), key).select(
        "column_name",
        "value",
        "n",
        (F.col("values_above") + F.row_number().over(within)).alias("dense_rank"),
        (F.col("rows_above") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("rows_before"),
        "total_rows",
    )
    return staged(ranked, "ranked_values")


def with_global_rank(
    df: DataFrame,
    ranked: DataFrame,
    column: str,
    rank: str,
    percentile: str | None = None,
) -> DataFrame:
    """Add the dense rank by the column, highest first, and optionally the percent rank * 100.

    `ranked` comes from ranked_values on the same frame. Rows without a value
    get no rank, and a value that very many rows share is joined in pieces.
    """
    below = F.greatest(F.col("total_rows") - 1, F.lit(1))
    added = [F.col("dense_rank").alias(rank)]
    if percentile:
        added.append((F.col("rows_before") / below * 100).alias(percentile))
    ranks = ranked.filter(F.col("column_name") == column).select(
        F.col("value").alias(column), F.col("n").alias("_rows"), *added
    )
    if dict(df.dtypes)[column] != "double":
        ranks = ranks.withColumn(column, F.col(column).cast(df.schema[column].dataType))
    return join_spread(df, ranks, column, "_rows").drop("_rows")


def quantile_frame(ranked: DataFrame, wanted: dict[str, Sequence[float]]) -> DataFrame:
    """One row with an array per column: for each share the smallest value reaching it."""
    up_to = F.col("total_rows") - F.col("rows_before")

    def reached(column: str, share: float) -> Column:
        hit = (F.col("column_name") == column) & (up_to >= F.ceil(F.col("total_rows") * share))
        return F.min(F.when(hit, F.col("value")))

    return ranked.agg(
        *[
            F.array(*[reached(column, share) for share in shares]).alias(column)
            for column, shares in wanted.items()
        ]
    )


def approximate_quantile_frame(
    df: DataFrame, wanted: dict[str, Sequence[float]], accuracy: int
) -> DataFrame:
    """The same by percentile_approx: one pass, no ranking, rank error 1 / accuracy."""
    return df.agg(
        *[
            F.percentile_approx(F.col(column).cast("double"), list(shares), accuracy).alias(column)
            for column, shares in wanted.items()
        ]
    )


def selected_quantile_frame(df: DataFrame, wanted: dict[str, Sequence[float]]) -> DataFrame:
    """The exact quantiles without ordering the values: a sketch brackets each, one pass counts and picks.

    The sketch is off by at most one rank in SKETCH_ACCURACY, so two of them to
    either side enclose the quantile. A second pass counts the rows below and
    above the bracket and each value inside, combined before the one shuffle;
    only the values inside, four in SKETCH_ACCURACY, are put in order.
    """
    slots = [(column, share) for column, shares in wanted.items() for share in shares]
    margin = 2 / SKETCH_ACCURACY
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    ends = {
        column: [min(max(share + side, 0.0), 1.0) for share in shares for side in (-margin, margin)]
        for column, shares in wanted.items()
    }
    sketch = numbers.agg(*[F.percentile_approx(c, e, SKETCH_ACCURACY).alias(c) for c, e in ends.items()])
    bracketed = numbers.withColumn("_ends", sketch.select(F.struct(*sketch.columns)).scalar())
    cells = []
    for slot, (column, share) in enumerate(slots):
        value, at = F.col(column), [s for c, s in slots[:slot] if c == column]
        low, high = (F.col("_ends")[column][2 * len(at) + side] for side in (0, 1))
        below = F.lit(False) if share <= margin else value < low
        above = F.lit(False) if share >= 1 - margin else value > high
        side = F.when(below, -1).when(above, 1).otherwise(0)
        cells.append(
            F.struct(
                F.lit(slot).alias("slot"),
                F.when(value.isNotNull(), side).alias("side"),
                F.when(side == 0, value).alias("value"),
            )
        )
    counts = (
        bracketed.select(F.inline(F.array(*cells)))
        .filter(F.col("side").isNotNull())
        .groupBy("slot", "side", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = Window.partitionBy("slot")
    upward = whole.orderBy("side", "value").rowsBetween(Window.unboundedPreceding, 0)
    shares = F.element_at(F.array(*[F.lit(float(share)) for _, share in slots]), F.col("slot") + 1)
    reached = counts.select(
        "slot",
        "value",
        (F.sum("n").over(upward) >= F.ceil(F.sum("n").over(whole) * shares)).alias("reached"),
    ).filter("reached AND value IS NOT NULL")
    picked = reached.groupBy().agg(
        *[F.min(F.when(F.col("slot") == slot, F.col("value"))).alias(f"_{slot}") for slot in range(len(slots))]
    )
    numbered = list(enumerate(slots))
    return picked.select(
        *[F.array(*[F.col(f"_{slot}") for slot, (c, _) in numbered if c == column]).alias(column) for column in wanted]
    )


def quantiles(
    df: DataFrame,
    wanted: dict[str, Sequence[float]],
    cfg: Settings = Settings(),
    ranked: DataFrame | None = None,
) -> dict[str, list[Column]]:
    """Quantiles as columns, usable in any expression: parts of one scalar subquery of the plan.

    Exact unless the settings name an accuracy. `ranked`, from ranked_values on
    the same frame, saves a pass over it. Nothing runs here. Without rows they
    are NULL.
    """
    if cfg.quantile_accuracy is not None:
        row = approximate_quantile_frame(df, wanted, cfg.quantile_accuracy)
    elif ranked is not None:
        row = quantile_frame(ranked, wanted)
    else:
        row = selected_quantile_frame(df, wanted)
    found = row.select(F.struct(*row.columns)).scalar()
    return {
        column: [found[column][n] for n in range(len(shares))] for column, shares in wanted.items()
    }
