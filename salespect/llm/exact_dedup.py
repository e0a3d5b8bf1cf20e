"""Exact duplicates by a stateful stream with an index on disk that never expires.

1. The table's files are a stream. Its state is keyed by the digest of a text
   and held in RocksDB, without watermark or expiry: the number of rows, the
   stable identifier (greatest id) and the content locator (file and row within
   it) of the row that stays. A later call with the same state folder reads only
   files that are new and extends the same index.
2. The index is read back from the state store. Where a digest was hit more than
   once, the texts are fetched through it and every copy is compared byte by
   byte with the text at the locator.
3. Rows whose bytes differ under one digest are grouped by their text instead.

Only DataFrame functions are used; no text enters the state or the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespect.functions.staging import staged, staging_path

PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Logs sized in advance take some megabytes per partition, whatever it holds.
    f"{STATE_STORE}.rocksdb.allowFAllocate": "false",
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    # A partition's store is closed with its task: open ones take memory outside the heap until a clean-up a minute later.
    f"{STATE_STORE}.unloadOnCommit": "true",
}
BATCH_BYTES = 1 << 40  # of files in one trigger of the stream
PIECE_BYTES = 256 << 20  # of copies that one task compares with their text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _columns(table: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(id, text, file, row, digest) of a batch or stream of files; a null text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return table.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *place, digest(text).alias("digest"))


def _pattern(path: str) -> str:
    """The path as a pattern that matches it alone: a stream takes a single file only as a match."""
    return f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path


def remember(spark: SparkSession, path: str, state: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES) -> None:
    """Take the Parquet files below path that the index in the state folder has not seen into it."""
    path = path.rstrip("/")
    # A session of its own keeps the state store's settings out of the caller's.
    session = spark.newSession()
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set(PARTITIONS, spark.conf.get(PARTITIONS))
    stream = session.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(_pattern(path))
    rows = _columns(stream, id_col, text_col, digest)
    keep = F.struct("id", "file", "row", F.octet_length("text").alias("bytes"))
    index = rows.select("digest", keep.alias("keep")).groupBy("digest").agg(F.count("*"), F.max("keep"))
    # The state itself is the result; the rows that a trigger changes need no sink.
    run = index.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
    run.awaitTermination()


def remembered(spark: SparkSession, state: str) -> DataFrame:
    """The index: (digest, group_size, keep_id, keep_file, keep_row, keep_bytes)."""
    kept = F.col("value.max")
    return (
        spark.read.format("statestore")
        .load(state)
        .select(
            F.col("key.digest").alias("digest"),
            F.col("value.count").alias("group_size"),
            *[kept[f].alias(f"keep_{f}") for f in ("id", "file", "row", "bytes")],
        )
    )


def _differing(texts: DataFrame, index: DataFrame) -> DataFrame:
    """Digests under which some row's bytes are not those at the locator.

    Texts of digests with one row are left out of the scan by a filter of eight
    bytes per repeated digest, which is broadcast only where Spark finds it
    small. The copies of one text are dealt over a task per PIECE_BYTES of
    them, and their text is repeated as often.
    """
    hits = staged(index.where("group_size > 1"), "hits")
    keys = staged(hits.select(F.xxhash64("digest").alias("hit")).distinct(), "hit-keys")
    copies = texts.join(keys, F.xxhash64("digest") == F.col("hit"), "left_semi")
    pieces = F.least(F.ceil(F.col("group_size") * F.col("keep_bytes") / PIECE_BYTES), F.col("group_size"))
    large = hits.where(pieces > 1).select("digest", pieces.alias("pieces"))
    # At most one row for each PIECE_BYTES of the table: safe to broadcast at any size.
    dealt = copies.join(F.broadcast(large), "digest", "left").withColumn("piece", F.pmod(F.xxhash64("file", "row"), F.coalesce("pieces", F.lit(1))))
    place = hits.select("digest", F.col("keep_file").alias("file"), F.col("keep_row").alias("row"), F.greatest(pieces, F.lit(1)).alias("of"))
    found = copies.join(place, ["digest", "file", "row"]).select("digest", F.col("text").alias("kept"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1)).alias("piece"))
    return dealt.join(found, ["digest", "piece"]).where("text <> kept").select("digest").distinct()


def exact_duplicates(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of the Parquet table at path: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are; a null text is an empty one. Of equal
    texts the row of greatest id stays; of rows that share that id, or have
    none, the one that comes last by file and place, so exactly one of a group
    is kept. A null id is smaller than any other and gives a null keep_id only
    if the whole group has none. Other columns are ignored, an empty table gives
    an empty result. `state` names a folder that all executors reach, whose
    index must cover the same table; without it a new one is used.
    """
    path = path.rstrip("/")
    state = state or staging_path(spark, "seen")
    remember(spark, path, state, id_col, text_col, digest, batch_bytes)
    index = staged(remembered(spark, state), "index")
    texts = _columns(spark.read.parquet(path), id_col, text_col, digest)
    differing = staged(_differing(texts, index), "differing")
    rows = texts.withColumn("sha", sha256(F.col("text")))
    result = ["id", "keep_id", "group_size", "file", "row", "keep_file", "keep_row", "sha"]
    plain = rows.drop("text")
    if differing.limit(1).count():
        same, other = plain.join(differing, "digest", "left_anti"), rows.join(differing, "digest", "left_semi")
        own = other.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "file", "row")).alias("keep"))
        own = own.select("digest", "text", "group_size", *[F.col(f"keep.{f}").alias(f"keep_{f}") for f in ("id", "file", "row")])
        found = same.join(index, "digest").select(result).unionByName(other.join(own, ["digest", "text"]).select(result))
    else:
        found = plain.join(index, "digest").select(result)
    kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
