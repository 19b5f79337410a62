"""Plan helpers: shared staging, skew-safe joins, bounded key filters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many heavy keys are broadcast: a key is heavy from a HEAVY-th of all rows on.
HEAVY = 1000
#: Bits of a membership filter: FILTER_SPACE for each wanted key, between a page and MOST_BITS (16 MB broadcast).
PAGE, FILTER_SPACE, MOST_BITS = 1 << 15, 16, 1 << 27

#: Bytes of a batch that goes to a Python worker: rows are many or long, and both sides hold a batch whole.
BATCH_BYTES = 4 << 20

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bounds the batches of the session's Python stages by bytes (a single row may be longer); the default bounds rows only."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset in local mode (tests), one under the warehouse.

    On a cluster an unset folder raises: executors do not share the driver's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: cuts lineage, survives lost executors.

    Shuffle files of the write go when it ends, so a chain of stages holds those of one at a time.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables; only where all that reads them has been staged in its turn."""
    for t in tables:
        drop_folder(t.sparkSession, t.staged_at)


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def drop_folder(spark: SparkSession, path: str) -> None:
    system, where = _folder(spark, path)
    system.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _folder(spark, path)
    return system.exists(where)


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str, spread: Column, total: int) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per ``key``, not null) without a hot task.

    ``weight`` is how many of the ``total`` rows have the key. Keys with over 1/HEAVY of all rows
    number at most HEAVY, so that part of the table is broadcast. Their rows, and those without a
    key, go through the shuffle that joins the rest under ``spread`` in place of their key; what
    that happens to meet there is not taken.
    """
    names = [c for c in table.columns if c != key]
    kind = dict(table.dtypes)[key]
    floor = max(1, total // HEAVY)
    heavy = table.filter(F.col(weight) > floor).select(F.col(key).alias("_k"), F.struct(*names).alias("_heavy"))
    light = table.filter(F.col(weight) <= floor).select(F.col(key).alias("_k2"), F.struct(*names).alias("_light"))
    got = rows.join(F.broadcast(heavy), F.col(key) == F.col("_k"), "left").drop("_k")
    plain = F.col("_heavy").isNull() & F.col(key).isNotNull()
    got = got.withColumn("_at", F.when(plain, F.col(key)).otherwise(spread.cast(kind)))
    got = got.join(light, F.col("_at") == F.col("_k2"), "left")
    both = F.coalesce(F.col("_heavy"), F.when(plain, F.col("_light")))
    return got.select(*rows.columns, *[both[c].alias(c) for c in names])


def meet(rows: DataFrame, table: DataFrame, key: str, spread: Column, widen=lambda dealt: dealt) -> DataFrame:
    """Inner join of ``rows`` with a ``table`` of wide rows (one per ``key``), without a hot task or a broadcast of it.

    Rows of a key that holds over 1/HEAVY of all are dealt, by ``spread``, to as many parts as it has
    such shares, and the key's row of the table is repeated for each part: at most HEAVY repeats in
    all. Only those keys and their numbers of parts are broadcast. ``widen`` adds wide columns to the
    rows once they are dealt. ``rows`` is read three times: stage it.
    """
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > max(1, total // HEAVY))
    hot = F.broadcast(counts.select(F.col(key).alias("_k"), F.ceil(F.col("_n") * HEAVY / max(total, 1)).cast("int").alias("_parts")))
    dealt = rows.join(hot, F.col(key) == F.col("_k"), "left")
    dealt = dealt.withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(spread, F.col("_parts"))).cast("int")).drop("_k", "_parts")
    each = table.join(hot, F.col(key) == F.col("_k"), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    return widen(dealt).join(each.drop("_k", "_parts"), [key, "_part"]).drop("_part")


def near(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, hit: bool = True) -> DataFrame:
    """Rows whose key may be a wanted one (or, with hit=False, is surely none).

    A filter ahead of an exact join: no wanted row is lost, and about one other row in FILTER_SPACE
    passes as long as there are fewer wanted keys than MOST_BITS / FILTER_SPACE; beyond that more
    pass, up to all, and the broadcast stays at 16 MB. ``wanted`` is read twice: stage it.
    """
    size = min(MOST_BITS, max(PAGE, 1 << (FILTER_SPACE * wanted.count()).bit_length())) // 8
    byte = lambda k: F.pmod(F.xxhash64(k), F.lit(size))
    bit = lambda k: F.pmod(F.shiftright(F.xxhash64(k), 40), F.lit(7))  # noqa: E731  the eighth stays 0, so a byte reads as ASCII
    page, place = (lambda k: F.shiftright(byte(k), 12)), (lambda k: byte(k).bitwiseAND(PAGE // 8 - 1))
    pages = wanted.filter(wanted_key.isNotNull()).select(page(wanted_key).alias("_page"), (place(wanted_key) * 8 + bit(wanted_key)).alias("_at"))
    pages = pages.groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    held = F.getbit(F.ascii(F.substring(F.col("_bits"), (place(key) + 1).cast("int"), F.lit(1)).cast("string")), bit(key).cast("int")) == 1
    return rows.join(F.broadcast(pages), (page(key) == F.col("_page")) & held, "left_semi" if hit else "left_anti")
