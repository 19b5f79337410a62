"""Mixing sources to target weights by Sainte-Lague apportionment (built-in operators only).

Token targets by weight, capped at ``epochs`` times a source's size with the excess shared again,
become seats: the mix is cut into equal-token blocks and the blocks go to the sources with the
highest quotients target / (2k + 1). A source's blocks are dealt to the shards in integer quotas
that differ by one at most. The seed lays a source's documents out in one order, read over and over;
block k of a source is its k-th stretch of ``block_tokens`` words there, and each shard selects the
next blocks of its quota. What the mix takes of a document is the sum over the shards that hold
blocks with words of it.

The order is a seeded hash cut into buckets: positions come from bucket totals plus a window
inside one bucket, so a hot source is never sorted in one task. The targets and seats are windows
over one row a source, in one task: meant for up to some millions of sources.

Defined results: null or empty text has size 0, target share 0 and is taken 0 words; null source
is a source of its own, ordered last; rows that repeat are separate documents; an empty table
gives an empty result; other columns are ignored, and none may break it by its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .plan import staged

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 20240229
#: Blocks the whole mix is cut into, bits of the seeded order that make a bucket, and output shards.
BLOCKS, BUCKET_BITS, SHARDS = 1 << 16, 12, 64
#: Bits of the seeded order.
ORDER_BITS = 60
WORD = r"[^\x20\x09-\x0D]+"


def sized_column(name: str, text_col: str, id_col: str):
    """size: the words of the text; h: the place of the row in the seeded order."""
    if name == "size":
        return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias(name)
    seeded = F.concat_ws("/", F.lit(str(SEED)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(seeded), 1, ORDER_BITS // 4), 16, 10).cast("long").alias(name)


def sized(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *[sized_column(c, text_col, id_col) for c in ("size", "h")])


def targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) -> rank, target. Sources by code point, null last, weights repeating.

    A source is at its cap iff cap/weight is at most the level that the budget left by all smaller
    cap/weight ratios gives to the weights not yet capped; the level is then the same for the rest.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    s = sources.select("source", "source_size", rank.alias("rank"), weight.alias("weight"), (F.col("source_size") * epochs).cast("double").alias("cap"))
    up = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, rest = up.rowsBetween(W.unboundedPreceding, -1), up.rowsBetween(0, W.unboundedFollowing)
    s = s.withColumn("budget", F.sum("source_size").over(W.partitionBy()).cast("double"))
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    s = s.withColumn("open", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(W.partitionBy()))
    level = F.col("open")["level"]
    return s.select("source", "source_size", "rank", F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(level * F.col("weight")).alias("target"), "budget")


def seats(target: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Adds block_tokens and quota: the Sainte-Lague seats of each source.

    With n sources a final quota lies within 1 + n * share of target / block_tokens, so only
    quotients in that range (4n in all) compete; seats below it are sure.
    """
    block = F.greatest(F.lit(1), F.floor(F.col("budget") / blocks)).cast("long")
    n, share = F.count("*").over(W.partitionBy()), F.col("target") / F.greatest(F.col("budget"), F.lit(1.0))
    t = target.withColumn("block_tokens", block).withColumn("seats", F.floor(F.col("budget") / F.col("block_tokens")))
    t = t.withColumn("ideal", F.col("target") / F.col("block_tokens")).withColumn("slack", F.lit(1.0) + n * share)
    t = t.withColumn("sure", F.greatest(F.lit(0), F.floor(F.col("ideal") - F.col("slack"))).cast("long"))
    t = t.withColumn("open", F.col("seats") - F.sum("sure").over(W.partitionBy()))
    rivals = t.select("rank", "target", "open", F.explode(F.sequence("sure", F.ceil(F.col("ideal") + F.col("slack")).cast("long"))).alias("k"))
    rivals = rivals.withColumn("place", F.row_number().over(W.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "rank", "k")))
    won = rivals.filter((F.col("place") <= F.col("open")) & (F.col("target") > 0)).groupBy("rank").agg(F.count("*").alias("won"))
    return t.join(won, "rank", "left").select("source", "rank", "source_size", "target", "block_tokens", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota"))


def blocks_before(shard: str, shards: int) -> str:
    """SQL of how many of a source's ``quota`` blocks go to smaller shards."""
    return f"(quota * ({shard}) div {shards})"


def shard_quotas(seated: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Integer blocks of each source in each shard; they differ by at most one between shards."""
    s = seated.select("source", "quota", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    return s.select("source", "shard", F.expr(f"{blocks_before('shard + 1', shards)} - {blocks_before('shard', shards)}").alias("blocks"))


def shard_shares(epochs: int, shards: int):
    """array of (shard, words): what each shard's blocks hold of a row.

    Columns used: start (words of the source ahead of the row), size, source_size, tokens, block_tokens, quota.
    """
    passes = []
    for e in range(epochs):
        lo = f"({e} * source_size + start)"
        hi = f"least({lo} + size, tokens)"
        shard_of = lambda at: f"((({at}) div block_tokens + 1) * {shards} - 1) div quota"
        held = f"least({hi}, {blocks_before('k + 1', shards)} * block_tokens) - greatest({lo}, {blocks_before('k', shards)} * block_tokens)"
        passes.append(f"if({lo} < {hi}, transform(sequence({shard_of(lo)}, {shard_of(f'{hi} - 1')}), k -> named_struct('shard', cast(k as int), 'words', {held})), array())")
    return F.expr(f"filter(flatten(array({', '.join(passes)})), x -> x.words > 0)")


def placed(docs: DataFrame, text_col: str, source_col: str, id_col: str, weights, epochs: int, blocks: int, bucket_bits: int) -> DataFrame:
    """doc_id, source, size, h, start, and the plan of its source (source_size, target, block_tokens, quota, tokens) for each row."""
    rows = staged(sized(docs, text_col, source_col, id_col).withColumn("bucket", F.shiftright("h", ORDER_BITS - bucket_bits)), "sizes")
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    plan = seats(targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), weights, epochs), blocks)
    plan = staged(plan.withColumn("tokens", F.least(F.col("quota") * F.col("block_tokens"), F.col("source_size") * epochs)).drop("rank"), "quotas")
    parts = parts.withColumn("ahead", F.sum("part").over(W.partitionBy("source").orderBy("bucket")) - F.col("part"))
    parts = parts.withColumnRenamed("source", "_src").join(plan, F.col("source").eqNullSafe(F.col("_src"))).drop("_src", "part")
    parts = parts.withColumnsRenamed({"source": "_source", "bucket": "_bucket"})
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(parts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    return rows.withColumn("start", F.col("ahead") + F.col("inside")).drop("_source", "_bucket", "bucket", "ahead", "inside")


def mixture(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights=WEIGHTS, epochs: int = EPOCHS, blocks: int = BLOCKS, bucket_bits: int = BUCKET_BITS, shards: int = SHARDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and shares (shard, words) for each row of ``docs``."""
    rows = placed(docs, text_col, source_col, id_col, weights, epochs, blocks, bucket_bits).withColumn("shares", shard_shares(epochs, shards))
    taken = F.aggregate("shares", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "shares")


def apply_mixture(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Each row as many times as the mix takes it, rounded up to whole documents; rows without words stay once.

    In a source's order the rows that are taken once more come first, so one boundary a source decides,
    and texts are not shuffled as long as the table of sources is small enough for Spark to broadcast.
    """
    found = placed(docs, text_col, source_col, id_col, weights, epochs, BLOCKS, BUCKET_BITS).filter("size > 0")
    full = F.expr("tokens div source_size")
    more = F.when(F.col("start") < F.col("tokens") - full * F.col("source_size"), F.struct("h", "doc_id"))
    last = staged(found.groupBy(F.col("source").alias("_source")).agg(F.any_value(full).alias("_full"), F.max(more).alias("_last")), "boundaries")
    rows = docs.select("*", F.struct(*[sized_column(c, text_col, id_col) for c in ("size", "h")]).alias("_at"))
    rows = rows.join(last, F.col(source_col).eqNullSafe(F.col("_source")), "left")
    at = F.struct(F.col("_at.h").alias("h"), F.col(id_col).alias("doc_id"))
    once_more = F.when(F.col("_last").isNotNull() & (at <= F.col("_last")), 1).otherwise(0)
    times = F.when(F.col("_at.size") == 0, F.lit(1)).otherwise((F.col("_full") + once_more).cast("int"))
    return rows.withColumn("_times", times).filter("_times > 0").select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).drop("_copy")
