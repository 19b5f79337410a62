"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Items are groups of equal texts, and the granularity of the packing is a parameter: groups over
1/``grain`` of a shard in any dimension are items of their own, cut into pieces by a hash of the id
where they are over 1/``whole`` of a shard (sizes could not be near equal otherwise); all other
groups are pooled by hash into ``bundles`` items a shard. So the items number at most
``shards * (bundles + 3 * grain + 3 * whole)`` at any input size; they are placed on the driver, largest first,
each into the shard where the dot product of its vector with the residual capacity is highest, among
those that have room for its bytes. The law that holds is ``bytes``. Slots are numbered in parts of an item that hold about ``part_rows``
rows, so the sort of one task does not grow with the input.

Defined results: null text has no bytes and counts as a group of its own with the empty text (same
text CRC, 0); repeated rows are separate rows of one group; an empty table gives an empty result;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .plan import staged

#: A group over 1/GRAIN of a shard is an item of its own, and one over 1/WHOLE is cut.
SHARDS, BUNDLES, GRAIN, WHOLE, ROW_BYTES, PART_ROWS = 40, 128, 64, 8, 16, 1 << 19
WORD = r"[^\x20\x09-\x0D]+"


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of item vectors, bytes first): highest dot product with residual capacity.

    Shards whose bytes an item fits come first, as sizes are the law; where none has room, the emptiest takes it.
    """
    totals = np.maximum(items.sum(axis=0), 1).astype(float)
    unit = items / totals
    left = np.full((shards, items.shape[1]), 1.0 / shards)
    shard = np.zeros(len(items), np.int64)
    for i in np.argsort(-unit.max(axis=1), kind="stable"):
        fits = left[:, 0] >= unit[i, 0]
        shard[i] = j = int(np.argmax(np.where(fits, left @ unit[i], -np.inf) if fits.any() else left[:, 0]))
        left[j] -= unit[i]
    return shard


def shard_rows(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES, grain: int = GRAIN, whole: int = WHOLE, text_col: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, and the columns of ``keep``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("group"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    rows = rows if keep else staged(rows, "sizes")
    spark = docs.sparkSession
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = staged(groups, "groups")
    totals = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "tokens", "rows")]).first()
    part = lambda parts: [(F.col(c), max(totals[c] // (shards * parts), 1)) for c in ("size", "tokens", "rows")]
    own = [c > m for c, m in part(grain)]
    pieces = F.greatest(*[F.ceil(c / F.lit(m)) for c, m in part(whole)]).cast("long")
    # In each dimension at most shards * grain groups weigh that much: a bounded broadcast.
    large = groups.filter(own[0] | own[1] | own[2]).select(F.col("group").alias("_g"), pieces.alias("pieces"))
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * bundles))
    piece = F.concat_ws("-", F.hex("group"), F.pmod(F.xxhash64("doc_id", "size"), F.col("pieces")))
    rows = rows.join(F.broadcast(large), F.col("group") == F.col("_g"), "left").withColumn("item", F.when(F.col("pieces").isNull(), bundle.cast("string")).otherwise(piece)).drop("_g", "pieces", "group")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text_crc32", "doc_id", "size"), F.lit(totals["rows"] // (shards * bundles * part_rows) + 1)))
    counted = staged(rows.groupBy("item", "part").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "items")
    found = counted.groupBy("item").agg(*[F.sum(c).alias(c) for c in ("size", "tokens", "rows")]).orderBy("item").collect()
    shard = place(np.array([[r["size"], r["tokens"], r["rows"]] for r in found], np.int64).reshape(-1, 3), shards)
    ahead, next_slot = [], [0] * shards
    for r, j in zip(found, shard, strict=True):
        ahead.append(next_slot[j])
        next_slot[j] += r["rows"]
    at = spark.createDataFrame([(r["item"], int(j), a) for r, j, a in zip(found, shard, ahead, strict=True)], "item string, shard int, ahead long")
    before = F.coalesce(F.sum("rows").over(W.partitionBy("item").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = counted.withColumn("before", before).join(F.broadcast(at), "item").select(F.col("item").alias("_item"), F.col("part").alias("_part"), "shard", (F.col("ahead") + F.col("before")).alias("ahead"))
    nth = F.row_number().over(W.partitionBy("item", "part").orderBy("doc_id", "size", "text_crc32"))
    out = rows.withColumn("nth", nth).join(parts, (F.col("item") == F.col("_item")) & (F.col("part") == F.col("_part")))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"kept_{c}").alias(c) for c in keep])
