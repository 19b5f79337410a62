"""Substring deduplication on a token De Bruijn graph that is compacted by Spark joins.

Edges are the ``WINDOW``-token windows of the texts, from the node of their first to the node of
their last ``WINDOW - 1`` tokens. A window is removed in a document where its tokens also start in
a document with a smaller id; so an edge's source is its least document.

0. Of documents with one text only the least goes on; in its copies every window is removed.
1. Each window is represented by the least ``ANCHOR``-token hash inside it (equal windows have equal
   anchors); about a quarter of the positions are anchors. Anchors in two texts or more are
   counted in one shuffle, and only documents that hold one go on, with those anchors.
2. Windows around repeated anchors are edges. Grouped by hash, those in several documents are
   repeated edges with a source coordinate (document and position).
3. Compaction: each repeated edge meets its head node. Where that has one way in and one way out, and
   the edge before stands one source coordinate earlier, both are on one path, so repeated nonbranching
   paths are named by the coordinate where they begin.
4. Occurrences meet the path of their edge; those that follow one path side by side become one span.
5. Spans are verified at their source coordinates: a digest of the span's tokens in the source must
   equal the digest of the tokens in the document. Only verified spans are removed. Windows of spans
   that fail (different windows under one hash) are grouped again by digests of their own tokens.

So results do not depend on hashes, only on digests of 16 bytes. No join emits pairs of documents:
each window meets its one source. Anchors, edges and spans that are very common are attached by
broadcast (see ``plan.attach``).

Defined results: null text has no words; texts under WINDOW words lose nothing; a null id is
neither smaller nor larger than any; rows that repeat an id are one document for the comparison,
so they do not remove each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import words
from .plan import attach, bounded_batches, discard, near, staged

WINDOW, ANCHOR = 13, 8
#: Bits of an edge's identity. Fewer make more spans fail their verification and change no result.
BITS = 64
#: Where an id has several texts, a text's number times this is added to its positions.
PART = 1 << 32


def window_anchors(c: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of every window inside one text."""
    starts = words.inner_starts(c.bounds, WINDOW)
    low = words.gram_hashes(c.hashes, ANCHOR)
    span, have = WINDOW - ANCHOR + 1, 1
    while have < span:  # sliding minimum by doubling
        step = min(have, span - have)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        have += step
    return starts, low[starts] if len(starts) else np.empty(0, np.uint64)


def _anchors(batches):
    """(class, text) -> class and anchor; runs of one anchor once."""
    for batch in batches:
        for c in words.chunks(batch.column(1), lower=False):
            starts, low = window_anchors(c)
            if not len(starts):
                continue
            doc = np.searchsorted(c.bounds, starts, "right") - 1
            new = np.concatenate([[True], (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])])
            own = batch.column(0).slice(c.first, c.last - c.first).take(pa.array(doc[new]))
            yield pa.RecordBatch.from_arrays([own, pa.array(low[new].view(np.int64))], names=["class", "anchor"])


def edge_rows(bits: int = BITS, nodes: bool = True):
    """(id, text, anchors, part) -> the windows whose anchor is repeated: id, position, edge and, on demand, its nodes."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        for batch in batches:
            wanted, parts = batch.column(2), batch.column(3).to_numpy().astype(np.int64)
            for c in words.chunks(batch.column(1), lower=False):
                starts, low = window_anchors(c)
                if not len(starts):
                    continue
                doc = np.searchsorted(c.bounds, starts, "right") - 1
                keep = np.zeros(len(starts), bool)
                first = np.searchsorted(doc, np.arange(c.last - c.first + 1))
                for k in range(c.last - c.first):
                    a, b = first[k], first[k + 1]
                    if a < b:
                        keep[a:b] = np.isin(low[a:b], np.array(wanted[c.first + k].values, np.int64).view(np.uint64))
                at, doc = starts[keep], doc[keep]
                if not len(at):
                    continue
                columns = [(words.gram_hashes(c.hashes, WINDOW) & mask)[at]]
                if nodes:
                    node = words.gram_hashes(c.hashes, WINDOW - 1)
                    columns += [node[at], node[at + 1]]
                ids = batch.column(0).slice(c.first, c.last - c.first).take(pa.array(doc))
                arrays = [ids, pa.array(at - c.bounds[doc] + parts[c.first + doc] * PART), *[pa.array(x.view(np.int64)) for x in columns]]
                whole = pa.RecordBatch.from_arrays(arrays, names=["id", "pos", "edge", "head", "tail"][: len(arrays)])
                for i in range(0, len(at), 1 << 16):
                    yield whole.slice(i, 1 << 16)

    return run


EDGE, NODES = "id long, pos long, edge long", ", head long, tail long"


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with the class of their text, and (id, class) of the copies: rows of a text that a smaller id has too.

    A class is a 64-bit hash of the text's digest, checked against the digests: should two texts
    share one, every id is a class of its own, and there are no copies to pass over.
    """
    bounded_batches(docs.sparkSession)
    own = F.xxhash64(F.md5("text"))
    rows = docs.filter("id is not null and text is not null").select("id", own.alias("class"), F.md5("text").alias("digest"))
    found = staged(rows.groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.min("digest").alias("_lo"), F.max("digest").alias("_hi")).filter("copies > 1"), "classes")
    if not found.filter("_lo <> _hi").isEmpty():
        return docs.withColumn("class", F.col("id")), rows.select("id", "class").limit(0)
    total = found.agg(F.sum("copies")).first()[0] or 0
    met = attach(near(rows.select("id", "class"), F.col("class"), found, F.col("class")), found.select("class", "least", "copies"), "class", "copies", F.xxhash64("id"), total)
    return docs.withColumn("class", own), staged(met.filter("least < id").select("id", "class").distinct(), "copies")


def candidates(rows: DataFrame) -> DataFrame:
    """(id, text, anchors, class, part): of each class with anchors that another class holds too, the document with the least id.

    ``part`` numbers the texts of one id.
    """
    known = rows.filter("id is not null")
    anchors = known.select("class", "text").mapInArrow(_anchors, "class long, anchor long")
    counted = anchors.groupBy("anchor").agg(F.min("class").alias("_a"), F.max("class").alias("_b"), F.count("*").alias("weight"))
    shared = staged(counted.filter("_a < _b").select("anchor", "weight"), "anchors")
    total = shared.agg(F.sum("weight")).first()[0] or 0
    found = attach(anchors, shared, "anchor", "weight", F.xxhash64("class"), total).filter("weight is not null")
    own = found.groupBy("class").agg(F.collect_set("anchor").alias("anchors")).join(known.groupBy("class").agg(F.min("id").alias("id")), "class")
    own = staged(own.withColumn("part", (F.row_number().over(W.partitionBy("id").orderBy("class")) - 1).cast("int")), "own")
    out = staged(near(known, F.col("id"), own, F.col("id")).join(own, ["id", "class"]).select("id", "text", "anchors", "part", "class"), "candidates")
    discard(shared, own)
    return out


def paths(edges: DataFrame) -> DataFrame:
    """Repeated edges with source coordinate (source, at) and the coordinate ``begin`` of their compacted path.

    Columns: edge, weight, source, at, begin.
    """
    # Where an edge stands several times in its source, any of the positions will do.
    found = edges.groupBy("edge").agg(F.min("id").alias("source"), F.min_by("pos", "id").alias("at"), F.max("id").alias("_last"), F.count("*").alias("weight"), F.min("head").alias("head"), F.min("tail").alias("tail"))
    found = staged(found.filter("source < _last").drop("_last"), "repeated")
    ends = found.select(F.explode(F.array(F.struct(F.col("head").alias("node"), F.lit(1).alias("out")), F.struct(F.col("tail").alias("node"), F.lit(0).alias("out")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.count("*").alias("ways"))
    branching = nodes.filter("out <> 1 or ways <> 2").select(F.col("node").alias("head"), F.lit(True).alias("opens"))
    joined = found.select("edge", "weight", "source", "at", "head").join(branching, "head", "left")
    along = W.partitionBy("source").orderBy("at")
    opens = F.col("opens").isNotNull() | ~F.lag("at").over(along).eqNullSafe(F.col("at") - 1)
    joined = joined.withColumn("opens", opens)
    before = W.partitionBy("source").orderBy("at").rowsBetween(W.unboundedPreceding, 0)  # at most one document's words
    begin = F.max(F.when(F.col("opens"), F.col("at"))).over(before)
    out = staged(joined.withColumn("begin", begin).select("edge", "weight", "source", "at", "begin"), "paths")
    discard(found)
    return out


def repeated_paths(docs: DataFrame) -> DataFrame:
    """(source, begin, words, occurrences): the compacted repeated spans by source coordinates."""
    table = paths(_edge_table(candidates(classes(docs)[0])))
    return table.groupBy("source", "begin").agg((F.max("at") - F.col("begin") + WINDOW).alias("words"), F.max("weight").alias("occurrences"))


def _edge_table(cands: DataFrame, bits: int = BITS, nodes: bool = True) -> DataFrame:
    return cands.select("id", "text", "anchors", "part").mapInArrow(edge_rows(bits, nodes), EDGE + NODES if nodes else EDGE)


def path_spans(cands: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, source, first, last, at): runs of windows, by first words, that follow one path of a smaller document from ``at`` on.

    Runs of the source itself that stand elsewhere than at the path are among them; they are not removed.
    """
    found = paths(_edge_table(cands, bits))
    total = found.agg(F.sum("weight")).first()[0] or 0
    met = attach(_edge_table(cands, bits, nodes=False), found, "edge", "weight", F.xxhash64("id", "pos"), total)
    met = met.filter("source < id or (source = id and pos <> at)").select("id", "source", "begin", (F.col("pos") - F.col("at")).alias("shift"), "pos")
    along = met.repartition("id").sortWithinPartitions("id", "source", "begin", "shift", "pos")
    out = staged(along.mapInArrow(_runs, "id long, source long, first long, last long, at long"), "spans")
    discard(found)
    return out


def _runs(batches):
    """(id, source, begin, shift, pos) in order -> runs of successive positions that agree in the others; a batch's end cuts them."""
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(5)]
        if not len(batch):
            continue
        opens = np.concatenate([[True], columns[4][1:] != columns[4][:-1] + 1])
        for x in columns[:4]:
            opens[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(opens)) - 1
        ids, source, _, shift, pos = columns
        arrays = (ids[first], source[first], pos[first], pos[last], pos[first] - shift[first])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["id", "source", "first", "last", "at"])


class Joined:
    """The words of a chunk, each followed by one space, as one text; ``at`` has the offsets of the words in it."""

    def __init__(self, c: words.Chunk):
        inside = words.SPACE[c.data]
        ends = np.zeros(len(inside), bool)
        ends[1:] = inside[:-1]  # with the first byte after each word
        self.data = np.where(inside, c.data, np.uint8(0x20))[inside | ends]
        self.at = np.concatenate([[0], np.cumsum(c.ends - c.starts + 1)])
        self.raw = memoryview(self.data.tobytes())

    def digest(self, first: int, n: int) -> bytes:
        return blake2b(self.raw[self.at[first] : self.at[first + n] - 1], digest_size=16).digest()

    def without(self, hit: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts without the words that are hit."""
        sizes = np.diff(self.at) * ~hit
        kept = self.data[np.repeat(~hit, np.diff(self.at))]
        stops = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        raw = kept.tobytes()
        return pa.array([raw[x : max(x, y - 1)].decode("utf-8", "surrogatepass") for x, y in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)], pa.string())


def _digests(batches):
    """(id, part, text, spans of position and number of words) -> id, position, number, digest of the tokens there."""
    for batch in batches:
        for c in words.chunks(batch.column(2), lower=False):
            joined = Joined(c)
            for k in range(c.first, c.last):
                begin, spans = int(c.bounds[k - c.first]) - batch.column(1)[k].as_py() * PART, batch.column(3)[k].as_py()
                digests = [joined.digest(begin + s["at"], s["n"]) for s in spans]
                columns = [pa.array([batch.column(0)[k].as_py()] * len(spans), pa.int64()), *[pa.array([s[x] for s in spans], pa.int64()) for x in ("at", "n")], pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "at", "n", "digest"])


def digests_at(cands: DataFrame, places: DataFrame) -> DataFrame:
    """(id, at, n, digest) of distinct staged (id, at, n): the tokens that stand in candidate id from position at on."""
    lists = places.groupBy("id", F.shiftright("at", 32).cast("int").alias("part")).agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    met = near(cands, F.col("id"), places, F.col("id")).select("id", "part", "text").join(lists, ["id", "part"])
    return met.select("id", "part", "text", "spans").mapInArrow(_digests, "id long, at long, n long, digest binary")


def told_spans(cands: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans with the digest at their source coordinate."""
    place = F.concat_ws(":", "source", "at", F.col("last") - F.col("first"))
    keyed = spans.withColumn("place", place)
    wanted = staged(keyed.groupBy("place").agg(F.count("*").alias("weight"), F.any_value("source").alias("id"), F.any_value("at").alias("at"), (F.any_value(F.col("last") - F.col("first")) + WINDOW).alias("n")), "places")
    found = digests_at(cands, wanted.select("id", "at", "n")).select(F.concat_ws(":", "id", "at", F.col("n") - WINDOW).alias("place"), "digest")
    told = staged(found.join(wanted.select("place", "weight"), "place").dropDuplicates(["place"]), "told")
    return attach(keyed, told, "place", "weight", F.xxhash64("id", "first"), spans.count()).drop("place", "weight")


GONE = "array<struct<first: bigint, last: bigint, digest: binary>>"
REBUILT = "id long, n_words long, n_removed long, kept string, failed array<struct<first: bigint, last: bigint>>"
FAILED = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _rebuilt(batches):
    """(id, text[, spans, whole, part]) -> id, n_words, n_removed, kept text (words joined by one space), spans that failed.

    A span holds where the digest of its tokens is the one told, or none is.
    """
    for batch in batches:
        told = batch.num_columns > 2
        for c in words.chunks(batch.column(1), lower=False):
            joined, counts, failed = Joined(c), np.diff(c.bounds), [[] for _ in range(c.last - c.first)]
            marks = np.zeros(len(c.hashes) + 1, np.int32)  # +1 where removal begins, -1 where it ends
            for k in range(c.last - c.first) if told else ():
                a, b = int(c.bounds[k]), int(c.bounds[k + 1])
                if batch.column(3)[c.first + k].as_py():
                    if b - a >= WINDOW:
                        marks[a] += 1
                        marks[b] -= 1
                    continue
                begin = a - batch.column(4)[c.first + k].as_py() * PART
                for s in batch.column(2)[c.first + k].as_py() or ():
                    first, stop = begin + s["first"], begin + s["last"] + WINDOW
                    if s["digest"] is None or joined.digest(first, stop - first) == s["digest"]:
                        marks[first] += 1
                        marks[stop] -= 1
                    else:
                        failed[k].append({"first": s["first"], "last": s["last"]})
            hit = np.cumsum(marks[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(hit)])[c.bounds])
            own = batch.column(0).slice(c.first, c.last - c.first)
            yield pa.RecordBatch.from_arrays([own, pa.array(counts), pa.array(removed), joined.without(hit, c.bounds), pa.array(failed, FAILED)], names=["id", "n_words", "n_removed", "kept", "failed"])


def regrouped(cands: DataFrame, spans: DataFrame, failed: DataFrame) -> DataFrame:
    """(id, first, last) of single windows to remove, of the failed (id, first, last): by digests of the windows' own tokens.

    All occurrences of an edge are spans over its one coordinate, so each window meets all documents that may hold it.
    """
    window = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last") - F.col("first"))).alias("i")
    each = spans.select("id", "source", "first", "at", window).select("id", "source", (F.col("first") + F.col("i")).alias("pos"), (F.col("at") + F.col("i")).alias("at"))
    bad = failed.select("id", "first", window).select("id", (F.col("first") + F.col("i")).alias("pos"))
    clash = each.join(bad, ["id", "pos"]).select("source", "at").distinct()
    held = each.join(clash, ["source", "at"]).unionByName(clash.select(F.col("source").alias("id"), "source", F.col("at").alias("pos"), "at"))
    held = staged(held, "clashes")
    found = digests_at(cands, staged(held.select("id", F.col("pos").alias("at"), F.lit(WINDOW).cast("long").alias("n")).distinct(), "places"))
    own = held.join(found.select("id", F.col("at").alias("pos"), "digest").dropDuplicates(["id", "pos"]), ["id", "pos"])
    least = own.groupBy("source", "at", "digest").agg(F.min("id").alias("least"))
    gone = own.join(least, ["source", "at", "digest"]).filter("least < id").join(bad, ["id", "pos"], "left_semi")
    return gone.select("id", F.col("pos").alias("first"), F.col("pos").alias("last")).distinct()


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """id, n_words, n_removed and the kept text of every row."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows, copies = classes(docs)
    cands = candidates(rows)
    spans = path_spans(cands, bits)
    part = F.shiftright("first", 32).cast("int").alias("part")

    def removals(found: DataFrame) -> DataFrame:
        """(id, class, spans, whole, part) of (id, first, last, digest)."""
        lists = found.groupBy("id", part).agg(F.collect_list(F.struct("first", "last", "digest")).alias("spans"))
        return lists.join(cands.select("id", "part", "class").distinct(), ["id", "part"]).withColumn("whole", F.lit(False))

    def rebuilt(gone: DataFrame, ids: DataFrame) -> DataFrame:
        # Only documents near a removal are shuffled to meet it; the filter's other hits find none.
        met = near(rows, F.col("id"), ids, F.col("id")).join(gone, ["id", "class"], "left")
        return met.select("id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"), F.coalesce("part", F.lit(0)).alias("part"), "class")

    none: dict[str, Column] = {"spans": F.lit(None).cast(GONE), "whole": F.lit(True), "part": F.lit(0)}
    gone = staged(removals(told_spans(cands, spans.filter("source < id"))).unionByName(copies.withColumns(none)), "gone")
    whole = near(docs, F.col("id"), gone, F.col("id"), hit=False).mapInArrow(_rebuilt, REBUILT)
    touched = staged(rebuilt(gone, gone).mapInArrow(_rebuilt, REBUILT), "touched")
    failed = touched.filter("size(failed) > 0")
    if not failed.isEmpty():  # different windows under one hash
        bad = staged(failed.select("id", F.explode("failed").alias("s")).select("id", "s.first", "s.last").distinct(), "failed")
        sound = spans.filter("source < id").join(bad.select("id").distinct(), "id", "left_semi").join(bad, ["id", "first", "last"], "left_anti").select("id", "first", "last")
        again = sound.unionByName(regrouped(cands, spans, bad)).withColumn("digest", F.lit(None).cast("binary"))
        ids = staged(bad.select("id").distinct(), "ids")
        mended = staged(removals(again).unionByName(copies.withColumns(none).join(ids, "id", "left_semi")), "mended")
        touched = touched.join(ids, "id", "left_anti").unionByName(rebuilt(mended, ids).join(ids, "id", "left_semi").drop("class").mapInArrow(_rebuilt, REBUILT))
    return whole.unionByName(touched).drop("failed")
