"""Exact deduplication as a stateful stream with disk-backed keyed state (built-in operators only).

A file stream feeds a keyed aggregation without watermark, so state never expires. It lives in a
``state`` folder (checkpoint and registry): a run that was cut off goes on there, and a later run reads
only the files that came since and meets all digests seen before. Without one, a folder of the run's own
is used and dropped. Per digest of
the normalised text the RocksDB state keeps the digest (the key), the stable identifier of the row
that stays (largest id), a content locator (file and row index) and the count. Each micro-batch
writes the keys it changed to the shared folder under its batch number, so a repeated batch
overwrites itself. Afterwards every hit (row of a digest seen more than once) has its full bytes
compared: the digest's rows are regrouped by the full normalised text, which also takes apart
different texts that share a digest.

Defined results: null text counts as empty; null ids order first, so a row with an id beats one
without; rows repeated with the same id tie, and the later content locator stays; an empty table
gives an empty result; columns other than the id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .plan import attach, drop_folder, exists, near, new_folder, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Settings of the state store while the stream runs.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    # A store leaves its executor's disk once its batch is committed to the checkpoint.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def with_digest(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """Id, locator (file, row index) and digest of the normalised text of each row."""
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select(F.col(id_col).cast("long").alias("id"), where.alias("loc"), normalised(F.col(text_col)).alias("norm")).withColumn("digest", digest(F.col("norm")))


def literal(path: str) -> str:
    """The path with the characters of patterns escaped, as Spark takes paths for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/"))


def as_pattern(path: str) -> str:
    """A pattern that matches the path only: a stream takes a pattern where it would not take one file."""
    return re.sub(r"([A-Za-z0-9])(?=[^A-Za-z0-9]*$)", r"[\1]", literal(path))


def stream_registry(spark: SparkSession, path: str, id_col: str, text_col: str, digest, max_bytes: int, state: str) -> DataFrame:
    """Runs the stream over all files not read yet; per digest: n, and id and loc of the row that stays."""
    schema = spark.read.parquet(literal(path)).select(id_col, text_col).schema
    out = f"{state}/registry"
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        rows = with_digest(spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes).parquet(as_pattern(path)), id_col, text_col, digest)
        seen = rows.groupBy("digest").agg(F.max(F.struct("id", "loc")).alias("top"), F.count("*").alias("n"))

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        query = seen.writeStream.outputMode("update").option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kind = "digest string, top struct<id: bigint, loc: struct<file: string, row: bigint>>, n bigint, batch long"
    updates = spark.read.schema(kind).option("recursiveFileLookup", "false").parquet(out) if exists(spark, out) else spark.createDataFrame([], kind)
    return updates.groupBy("digest").agg(F.max("n").alias("n"), F.max("top").alias("top"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest=lambda norm: F.sha2(norm, 256), max_bytes: int = 256 << 30, state: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, keep_id, group_size, kept, digest, loc.

    ``state`` is a folder that outlives the run; files once read must stay as they are.
    """
    home = state or new_folder(spark, "state")
    registry = staged(stream_registry(spark, path, id_col, text_col, digest, max_bytes, home), "seen")
    if state is None:
        drop_folder(spark, home)
    schema = spark.read.parquet(literal(path)).select(id_col, text_col).schema
    rows = with_digest(spark.read.schema(schema).parquet(literal(path)), id_col, text_col, digest)
    total = registry.agg(F.sum("n")).first()[0] or 0
    hits = registry.filter("n > 1")
    again = near(rows, F.col("digest"), hits, F.col("digest"))
    exact = staged(again.groupBy("digest", "norm").agg(F.max(F.struct("id", "loc")).alias("top"), F.count("*").alias("n")), "verified")
    clashing = exact.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")
    verified = exact.groupBy("digest").agg(F.count("*").alias("texts"), F.max("top").alias("vtop"), F.sum("n").alias("vn"))
    known = registry.join(verified, "digest", "left")
    known = known.select("digest", F.coalesce("vn", "n").alias("n"), F.coalesce("vtop", "top").alias("top"), F.coalesce("texts", F.lit(1)).alias("texts"))
    columns = ["id", "loc", "digest"]
    out = attach(rows.select(*columns), known, "digest", "n", F.xxhash64("id", "loc"), total)
    if not clashing.isEmpty():  # texts that differ under one digest: their groups are those of the full texts
        apart = rows.join(clashing, "digest", "left_semi").join(exact, ["digest", "norm"])
        out = out.filter("texts = 1").unionByName(apart.select(*columns, "n", "top", F.lit(2).cast("long").alias("texts")))
    return out.select("id", F.col("top.id").alias("keep_id"), F.col("n").alias("group_size"), (F.struct("id", "loc").eqNullSafe(F.col("top"))).alias("kept"), "digest", "loc")
