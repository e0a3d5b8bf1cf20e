"""Joins that give every row a fact about its value, however many rows share the value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_ROWS = 1_000_000


def join_spread(df: DataFrame, facts: DataFrame, key: str, rows: str, piece_rows: int | None = None) -> DataFrame:
    """Left join of df with facts, one row per key value; `rows` names how many rows of df have the value.

    A value of more than `piece_rows` rows is dealt over several tasks: its rows
    by a hash of theirs, its facts once for each. Only such values are
    broadcast, at most one per `piece_rows` rows of df. Rows without a value
    keep NULL facts.
    """
    piece_rows = piece_rows or PIECE_ROWS
    pieces = F.ceil(F.col(rows) / piece_rows)
    hot = facts.filter(F.col(rows) > piece_rows).select(key, pieces.alias("_pieces"))
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    dealt = df.join(F.broadcast(hot), key, "left").withColumn(
        "_piece", F.when(F.col("_pieces").isNotNull(), F.pmod(F.xxhash64(*hashed), F.col("_pieces"))).otherwise(F.lit(0).cast("long"))
    )
    copies = F.sequence(F.lit(0).cast("long"), F.greatest(pieces, F.lit(1)) - 1)
    spread = facts.withColumn("_piece", F.explode(copies))
    return dealt.join(spread, [key, "_piece"], "left").drop("_piece", "_pieces")
