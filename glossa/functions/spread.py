"""Dealing few rows to all cores ahead of Python work, in bounded batches; joins without hot tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch that goes to a Python worker: rows are many or long, and both sides hold a batch whole.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the batches of the session's Python stages by bytes (a single row may be longer); the default bounds rows only."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def widened(rows: DataFrame) -> DataFrame:
    """The rows in as many partitions as there are cores, if they are in fewer; else as they are, without a shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


#: A table of at most so many rows goes to every executor whole, by way of the driver.
SENT = 100_000


def at_hand(table: DataFrame) -> DataFrame | None:
    """The rows of a small ``table`` for broadcasting, worked out once and now; None if it has over SENT."""
    rows = table.limit(SENT + 1).collect()
    return table.sparkSession.createDataFrame(rows, table.schema) if len(rows) <= SENT else None


#: So many keys, those with most rows, are broadcast: any other key has at most this share of the rows.
HEAVY = 1000


def attached(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per text ``key``; ``n`` tells how many rows have it) without a hot task.

    The table's HEAVY most frequent keys are broadcast. Rows that these serve, and those without a
    key, are scattered through the join with the whole table under a hash of theirs in place of their
    key; what they happen to meet there is not taken. The table is read twice.
    """
    names = [c for c in table.columns if c not in (key, n)]
    heavy = table.orderBy(F.desc(n)).limit(HEAVY).select(F.col(key).alias("_k"), F.struct(*names).alias("_heavy"))
    got = rows.join(F.broadcast(heavy), F.col(key) == F.col("_k"), "left").drop("_k")
    plain = F.col("_heavy").isNull() & F.col(key).isNotNull()
    got = got.withColumn("_at", F.when(plain, F.col(key)).otherwise(F.xxhash64(*rows.columns).cast("string")))
    got = got.join(table.select(F.col(key).alias("_k"), F.struct(*names).alias("_light")), F.col("_at") == F.col("_k"), "left")
    both = F.coalesce("_heavy", F.when(plain, F.col("_light")))
    return got.select(*rows.columns, *[both[c].alias(c) for c in names])
