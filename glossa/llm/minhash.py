"""Near-duplicate documents by b-bit MinHash, with every link confirmed on the full shingle sets.

1. Each document's set of five-word shingles gives a fingerprint (the node), ``BANDS * ROWS``
   minima, band keys of ``ROWS`` minima each, and a signature that packs the low ``BITS`` bits of
   ``SIGNATURE`` minima. At similarity 0.75 two sets share a band with probability 1 - 6e-9.
2. Documents with one set are one node. Band buckets that hold two nodes or more are kept, each with
   its hub, the least node. A node is paired with the least hub that it meets, one pair a node, never
   all pairs of a bucket; the confirmed pairs give components, and then nodes meet their other hubs
   of another component.
3. Buckets of three nodes or more that still hold several components are compared inside, in blocks
   that are bounded by members and by bytes; only links that join components leave a block.
4. Before any confirmation, in steps 2 and 3, the packed signatures estimate the similarity: the bit
   count of the codes that agree, corrected for chance collisions. Pairs under ``NEAR`` are passed
   over (a pair at 0.75 is so with probability 2e-10); the others are confirmed on full sets.
5. The components are attached to the documents.

Nodes are 64-bit fingerprints of whole sets: two sets of n would share one with probability
n * n / 2**65.

Defined results: null, empty or blank text has no shingles and is linked with nothing; fewer than
five words are one shingle; repeated rows are copies; a null id orders last, so its component is
the least id there is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .components import components
from .plan import attach, bounded_batches, discard, meet, near, staged

K, BANDS, ROWS, SIGNATURE, BITS = 5, 50, 4, 128, 4
#: Links have 100 * intersection >= LEVEL * union.
LEVEL = 75
NEAR = 0.5
#: Members, and bytes of shingles, that a block holds on either side (a single set may hold more).
BLOCK, BLOCK_BYTES = 512, 16 << 20

_rng = np.random.default_rng(75)
_FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(c: words.Chunk) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of the chunk."""
    grams = words.gram_hashes(c.hashes, K)
    out = []
    for a, b in zip(c.bounds[:-1], c.bounds[1:], strict=True):
        n = int(b - a)
        if n >= K:
            out.append(np.unique(grams[a : b - K + 1]))
        else:  # a short sequence is one shingle, apart from those of other lengths
            out.append(words.gram_hashes(c.hashes[a:b], n) ^ np.uint64(n) if n else np.empty(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> np.uint64:
    """Of a sorted set; never 0."""
    at = words.mix(s + np.arange(1, len(s) + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return words.mix(at.sum(keepdims=True) + np.uint64(len(s)))[0] | np.uint64(1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (not empty) the least of each of the BANDS * ROWS hash functions."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(_FACTORS)), np.uint64)
    turned, space = flat ^ (flat >> np.uint64(31)), np.empty_like(flat)
    for j, f in enumerate(_FACTORS):
        np.multiply(turned, f, out=space)
        out[:, j] = np.minimum.reduceat(space, at)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(low), BANDS), np.uint64)
    for r in range(ROWS):
        keys = words.mix(keys * np.uint64(0x9FB21C651E98DF25) + low[:, r::ROWS])
    return words.mix(keys + np.arange(BANDS, dtype=np.uint64))


def packed(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of the first SIGNATURE minima (after mixing), packed into bytes."""
    codes = (words.mix(low[:, :SIGNATURE]) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return codes[:, 0::2] << 4 | codes[:, 1::2]  # two 4-bit codes a byte


_EQUAL = np.array([(int(x >> 4 == 0) + int(x & 15 == 0)) for x in range(256)], np.uint8)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of each packed signature of a with each of b, corrected for chance collisions."""
    same = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        same[i] = _EQUAL[row ^ b].sum(axis=1)
    chance = 2.0**-BITS
    return (same / SIGNATURE - chance) / (1 - chance)


def alike(a: Column, b: Column) -> Column:
    """The same estimate of two signatures given as arrays of longs: nibbles that differ, by bit count."""
    differ = []
    for i in range(SIGNATURE * BITS // 64):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(0x1111111111111111)
        differ.append(F.bit_count(x))
    chance = 2.0**-BITS
    return (1 - reduce(add, differ) / SIGNATURE - chance) / (1 - chance)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LEVEL * (len(a) + len(b) - both)


def _features(batches):
    for batch in batches:
        for c in words.chunks(batch.column(2)):
            sets = shingle_sets(c)
            some = [i for i, s in enumerate(sets) if len(s)]
            node = np.zeros(len(sets), np.uint64)
            node[some] = [fingerprint(sets[i]) for i in some]
            keys, codes = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), SIGNATURE * BITS // 64), np.int64)
            if some:
                low = minima([sets[i] for i in some])
                keys[some] = band_keys(low)
                codes[some] = packed(low).view(np.int64)
            lists = [words.list_array(x.ravel().view(np.int64), np.arange(len(sets) + 1) * x.shape[1], pa.int64()) for x in (keys, codes)]
            own = [batch.column(i).slice(c.first, c.last - c.first) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array([len(s) for s in sets], pa.int64()), pa.array(node.view(np.int64), mask=node == 0), *lists], names=["id", "text_key", "n", "node", "bands", "codes"])


def _sets(batches):
    for batch in batches:
        for c in words.chunks(batch.column(1)):
            sets = shingle_sets(c)
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.last - c.first), words.list_array(flat.view(np.int64), at, pa.int64())], names=["node", "shingles"])


def _compare(_, table):
    """Links of one block of strays (left) with one block of members that join components not joined yet."""
    stray = table["stray"].to_numpy(zero_copy_only=False)
    node, label = table["node"].to_numpy(), table["label"].to_numpy().copy()
    codes = table["codes"].combine_chunks().flatten().to_numpy().view(np.uint8).reshape(len(node), -1)
    sets = [np.array(s.values, np.int64) for s in table["shingles"]]
    left, right, found = np.flatnonzero(stray), np.flatnonzero(~stray), []
    if len(left) and len(right):
        for x, y in zip(*np.nonzero(estimates(codes[left], codes[right]) >= NEAR), strict=True):
            i, j = left[x], right[y]
            if label[i] != label[j] and linked(sets[i], sets[j]):
                found.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def buckets(features: DataFrame, total: int) -> DataFrame:
    """(key, node, hub, n): the members of the band buckets that hold two nodes or more, each once.

    The hub is the bucket's least node. Rows meet their bucket once; no pair of members does.
    """
    held = features.filter("node is not null").select("node", "n", F.explode("bands").alias("key"))
    found = held.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("_last"), F.count("*").alias("weight"))
    found = staged(found.filter("hub < _last").drop("_last"), "buckets")
    met = attach(near(held, F.col("key"), found, F.col("key")), found, "key", "weight", F.xxhash64("node"), total * BANDS).filter("hub is not null")
    met = staged(met.select("key", "node", "hub", "n").distinct(), "members")
    discard(found)
    return met


def labelled(met: DataFrame, label: DataFrame) -> DataFrame:
    """Members with their label; a node without one is its own."""
    return met.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))


def apart(met: DataFrame, label: DataFrame) -> DataFrame:
    """(hub, node) of the members whose hub has another label."""
    hubs = met.groupBy("hub").agg(F.count("*").alias("weight"))
    hubs = hubs.join(label.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub", "left").withColumn("hub_label", F.coalesce("hub_label", "hub"))
    rows = attach(labelled(met, label), hubs, "hub", "weight", F.xxhash64("node"), met.count())
    return rows.filter("label <> hub_label").select("hub", "node").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """id, text_key, n, component for every row of (id, text). text_key is a hash of the text."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("id", F.xxhash64("text").alias("text_key"), "text")
    kind = "id long, text_key long, n long, node long, bands array<long>, codes array<long>"
    features = staged(docs.mapInArrow(_features, kind), "features")
    found = features.filter("node is not null").groupBy("node")
    nodes = found.agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.min(F.struct("id", "text_key")).alias("rep"), F.any_value("n").alias("n"), F.any_value("codes").alias("codes"))
    nodes = staged(nodes, "nodes")
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    met = buckets(features, total)
    sets = staged(_node_sets(docs, staged(nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "rep"), "wanted")), "sets")
    # First each node meets the least hub of all its buckets: one pair a node.
    first = staged(met.groupBy("node").agg(F.min("hub").alias("hub")).filter("hub <> node").select("hub", "node"), "pairs")
    links = staged(confirmed(first, nodes, sets), "links")
    label = components(links)
    # Then the other hubs, only where that left node and hub apart.
    again = staged(apart(met, label).join(first, ["hub", "node"], "left_anti"), "pairs")
    if not again.isEmpty():
        links = staged(links.union(confirmed(again, nodes, sets)), "links")
        label = components(links)
    # Then the members of a bucket among one another, where it still holds several components.
    more = _inside(labelled(met, label), nodes, sets)
    if not more.isEmpty():
        label = components(links.union(more))
    known = nodes.join(label.withColumnRenamed("label", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component"), F.sum("copies").alias("size"))
    table = staged(attach(known.select("root", "node", "copies"), least, "root", "size", F.xxhash64("node"), total).select("node", "component", "copies"), "components")
    discard(nodes, met, sets, first, again)
    out = attach(features.select("id", "text_key", "n", "node"), table, "node", "copies", F.xxhash64("id"), total)
    return out.withColumn("component", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))).drop("node", "copies")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept for every row."""
    out = classes(docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")))
    return out.select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the staged (hub, node) pairs that are linked: by size, by signature, then by full sets."""
    about = lambda name: nodes.select(F.col("node").alias(name), F.col("n").alias(f"_n_{name}"), F.col("codes").alias(f"_codes_{name}"))
    hubs = pairs.groupBy("hub").agg(F.count("*").alias("weight")).join(about("hub"), "hub")
    both = attach(pairs.join(about("node"), "node"), hubs, "hub", "weight", F.xxhash64("node"), pairs.count())
    small, large = F.least("_n_hub", "_n_node"), F.greatest("_n_hub", "_n_node")
    likely = both.filter((100 * small >= LEVEL * large) & (alike(F.col("_codes_hub"), F.col("_codes_node")) >= NEAR))
    likely = staged(likely.select("hub", "node"), "likely")
    own = lambda name, shingles: sets.select(F.col("node").alias(name), F.col("shingles").alias(shingles))
    both = meet(likely, own("hub", "_x"), "hub", F.xxhash64("node"), lambda dealt: dealt.join(own("node", "_y"), "node"))
    shared = F.size(F.array_intersect("_x", "_y"))
    return both.filter(100 * shared >= LEVEL * (F.size("_x") + F.size("_y") - shared)).select(F.col("hub").alias("a"), F.col("node").alias("b"))


def _node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) for wanted (node, rep): the set of one document with that id and text key."""
    name = lambda of: F.concat_ws("/", F.col(f"{of}id"), F.col(f"{of}text_key"))
    rows = near(docs, F.col("text_key"), wanted, F.col("rep.text_key")).withColumn("_row", name("")).dropDuplicates(["_row"])
    rows = rows.join(wanted.select("node", name("rep.").alias("_row")), "_row")
    sets = rows.select("node", "text").mapInArrow(_checked_sets, "node long, shingles array<long>")
    return sets.dropDuplicates(["node"])


def _checked_sets(batches):
    """Of _sets, only rows whose text has the node's fingerprint."""
    for batch in _sets(batches):
        node, shingles = batch.column(0), batch.column(1)
        ok = [len(s) > 0 and int(fingerprint(np.array(s.values, np.int64).view(np.uint64)).view(np.int64)) == n.as_py() for n, s in zip(node, shingles, strict=True)]
        yield batch.filter(pa.array(ok, pa.bool_()))


def _inside(members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components that share a bucket of three nodes or more; members: (key, node, label, n).

    Strays, the members outside a bucket's largest component, meet all members: strays and members
    are dealt to blocks, and each block of strays meets each block of members. So a member is there
    once for each block of strays, and where strays are few, once.
    """
    sums = F.sum(F.xxhash64("node").cast("decimal(20,0)")).cast("string")
    parts = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n").alias("mass"), sums.alias("_sum"))
    size = parts.groupBy("key").agg(
        F.count("*").alias("labels"), F.sum("n").alias("size"), F.sum("mass").alias("mass"), F.max(F.struct("n", "label", "mass")).alias("top"), F.sum(F.col("_sum").cast("decimal(38,0)")).alias("_sum")
    ).filter("labels > 1 and size > 2")
    size = size.select("key", "size", "mass", F.col("top.label").alias("top"), (F.col("size") - F.col("top.n")).alias("other"), (F.col("mass") - F.col("top.mass")).alias("other_mass"), "_sum")
    # Buckets with the same members need one comparison.
    size = staged(size.groupBy("size", "mass", "top", "other", "other_mass", "_sum").agg(F.min("key").alias("key")).drop("_sum"), "mixed")
    if size.isEmpty():
        return size.select(F.col("key").alias("a"), F.col("key").alias("b"))
    rows = attach(members.select("key", "node", "label"), size, "key", "size", F.xxhash64("node"), members.count()).filter("size is not null")
    count = lambda n, mass: F.ceil(F.greatest(F.col(n) / BLOCK, F.col(mass) * 8 / BLOCK_BYTES)).cast("int")
    blocks, strays = count("size", "mass"), count("other", "other_mass")
    dealt = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = rows.filter("label <> top").select("key", "node", "label", F.lit(True).alias("stray"), dealt(strays).alias("one"), every(blocks).alias("two"))
    right = rows.select("key", "node", "label", F.lit(False).alias("stray"), dealt(blocks).alias("two"), every(strays).alias("one"))
    rows = left.unionByName(right).join(nodes.select("node", "codes"), "node").join(sets, "node")
    return staged(rows.groupBy("key", "one", "two").applyInArrow(_compare, "a long, b long"), "links").distinct()


def keep_one(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``near_duplicates`` keeps, all columns; rows that repeat a kept id and text stay."""
    found = classes(docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")))
    gone = staged(found.filter(~F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("_gone"), F.col("text_key").alias("_text")).distinct(), "dropped")
    own = F.xxhash64(text_col)
    rest = near(docs, own, gone, F.col("_text"), hit=False)
    some = near(docs, own, gone, F.col("_text"))
    return rest.unionByName(some.join(gone, F.col(key).cast("long").eqNullSafe(F.col("_gone")) & (own == F.col("_text")), "left_anti"))
