"""Token counts: whole texts encoded in Arrow batches balanced by bytes, lengths only."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.llm.tokens import Encoder, balanced


def _counted(batches, path: str):
    encoder = Encoder(path)
    for batch in batches:
        counts = np.zeros(batch.num_rows, np.int64)
        for first, texts in balanced(batch.column(1)):
            counts[first : first + len(texts)] = [len(ids) // 4 for ids in encoder.encode(texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts)], ["id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id, n_bytes, n_tokens, over_limit).

    A null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids keep
    their rows; other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(partial(_counted, path=tokenizer), "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
