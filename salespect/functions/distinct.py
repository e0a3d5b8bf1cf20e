"""Sums and exact distinct counts by the same keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespect.functions.columns import distinct_count


def grouped(df: DataFrame, keys: Sequence[str], measures: dict[str, Column | str], exact: bool = True) -> DataFrame:
    """Aggregates by the keys; a measure given as a column's name is the number of its distinct values.

    One aggregation with several distinct counts would shuffle every line once
    for each of them, along with room for all sums. Here each count has rows of
    its own that hold the keys and the value alone, so each is a scan of `df`:
    pass a stored one. Approximate counts are part of the one aggregation.
    """
    counted = {name: column for name, column in measures.items() if isinstance(column, str)}
    if not exact or not counted:
        return df.groupBy(*keys).agg(
            *[(distinct_count(m, exact) if isinstance(m, str) else m).alias(name) for name, m in measures.items()]
        )
    totals = df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items() if name not in counted])
    by = [F.col(k).alias(f"_{k}") for k in keys]
    pairs = [
        df.filter(F.col(column).isNotNull()).select(*by, column).distinct().select(*[f"_{k}" for k in keys], F.lit(n).alias("_of"))
        for n, column in enumerate(counted.values())
    ]
    counts = reduce(DataFrame.union, pairs).groupBy(*[f"_{k}" for k in keys]).agg(
        *[F.count_if(F.col("_of") == n).alias(name) for n, name in enumerate(counted)]
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    zero = F.lit(0).cast("long")
    return totals.join(counts, same, "left").select(
        *keys, *[F.coalesce(F.col(name), zero).alias(name) if name in counted else name for name in measures]
    )
