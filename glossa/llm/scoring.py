"""Language-model scoring with a weighted backoff automaton trained on the corpus.

Counts: every word and every pair of neighbours of every training document is counted exactly (a
shuffle by word, and by pair). The model is a bigram with absolute discounting that backs off to a unigram with Good-Turing mass for unknown
words. Its automaton has a root and one state for each context; a state holds arcs for the words
seen after it LEAST times or more, at any input size, and a failure arc, with the backoff weight, to
the root. One left-to-right traversal per document carries the state and adds up log10 probabilities.

What a worker holds is bounded at any input size: words over 1/WORDS of all tokens (at most WORDS)
and arcs over 1/ARCS (at most ARCS). The weights of all other words and arcs stay in tables: the
traversal takes the failure arc and emits what it does not hold, words meet their root and failure
weights in a shuffle, pairs meet what their arc adds to them (in PASSES parts, one on disk at a
time), and the sums come back. So the result is the whole automaton's, and WORDS, ARCS and PASSES do not change it. A pair is told by a 64-bit
combination of its words' hashes where a document's pairs meet the arcs; pairs that a bitmap of the
arcs (at most 16 MB) rules out are not shuffled.

A row is told by a 64-bit hash while its sums come together; rows that share one by chance are found
first and scored apart under another hash.

Defined results: null or empty text is one end token; a null id counts as the text ''; rows that
repeat are scored each; without training rows every probability is 1 (log 0); an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .plan import MOST_BITS, PAGE, bounded_batches, discard, near, staged

#: Words and arcs that workers hold, as parts of all tokens. A held arc's words are held: ARCS <= WORDS.
WORDS, ARCS = 1 << 22, 1 << 22
#: Times that a pair with an arc is seen at least; parts of the pairs that meet their arcs one by one.
LEAST, PASSES = 2, 2
DISCOUNT = 0.5
END = np.uint64(0x5EED5EED00000001)  # as a context: the start of a text
PAIR = np.uint64(0x9FB21C651E98DF25)
FLUSH = 1 << 20


def in_part(key: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


class _Counter:
    """Counts of int64 keys with bounded memory: gives partial counts whenever FLUSH is passed.

    ``names``: of the key, the count, and columns that follow from the key.
    """

    def __init__(self, *names: str):
        self.parts, self.size, self.names = [], 0, list(names)

    def add(self, keys: np.ndarray, *more: np.ndarray):
        if more:
            keys, first, n = np.unique(keys, return_index=True, return_counts=True)
            got = (keys, n, *[x[first] for x in more])
        else:
            got = np.unique(keys, return_counts=True)
        self.parts.append(got)
        self.size += len(got[0])
        if self.size > FLUSH:
            self.parts = [self._merged()]
            self.size = len(self.parts[0][0])
            if self.size > FLUSH // 2:
                yield from self.rest()

    def _merged(self):
        keys, n, *more = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(n, first), *[x[order[first]] for x in more]

    def rest(self):
        if self.size:
            columns = self._merged()
            self.parts, self.size = [], 0
            for i in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[i : i + (1 << 16)]).view(np.int64)) for x in columns], names=self.names)


def with_ends(c: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's word hashes with an end token after each text, and the new bounds."""
    bounds = c.bounds + np.arange(len(c.bounds))
    out = np.empty(bounds[-1], np.uint64)
    out[bounds[1:] - 1] = END
    inner = np.ones(len(out), bool)
    inner[bounds[1:] - 1] = False
    out[inner] = c.hashes
    return out, bounds


def counts(train: DataFrame, text_col: str) -> DataFrame:
    """(w, c): every distinct token of the rows, ends included."""

    def run(batches):
        counter = _Counter("w", "c")
        for batch in batches:
            for c in words.chunks(batch.column(0)):
                yield from counter.add(with_ends(c)[0])
        yield from counter.rest()

    return train.select(text_col).mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _collect(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table[c].to_numpy() for c in names]


class Index:
    """Positions of distinct 64-bit keys, by open addressing; ``find`` gives -1 for others."""

    def __init__(self, keys: np.ndarray):
        self.keys, bits = keys, max(4, (2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self.slot(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & self.last

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * PAIR) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot(keys)
        out = self.slots[at].astype(np.int64)
        if len(self.keys):
            todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
            while len(todo):
                at[todo] = (at[todo] + 1) & self.last
                out[todo] = got = self.slots[at[todo]]
                todo = todo[(got >= 0) & (self.keys[got] != keys[todo])]
        return out


class Vocabulary:
    """Frequent words: sorted hashes and counts; ``find`` gives positions, -1 for other words."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray, total: int):
        order = np.argsort(hashes)
        self.hashes, self.n, self.total = hashes[order], n[order], total
        self.find = Index(self.hashes).find


def contexts(ids: np.ndarray, bounds: np.ndarray, begin: int) -> np.ndarray:
    """The token before each token; ``begin`` at the start of a text."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[bounds[:-1]] = begin
    return before


def paired(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return before * PAIR + tokens


def preceding(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each token; END at the start of a text."""
    return contexts(tokens.view(np.int64), bounds, END.view(np.int64)).view(np.uint64)


def in_pass(pairs: np.ndarray, number: int) -> np.ndarray:
    return (pairs >> np.uint64(32)) % np.uint64(PASSES) == number


def bigrams(train: DataFrame, text_col: str, repeated=None) -> DataFrame:
    """(x, w, c): counts of all pairs of a context and its successor, or of those whose words may both be in the bitmap ``repeated``.

    A pair that is seen twice has words that are, so pairs of others need no count.
    """

    def split(out):
        k, x = (out.column(i).to_numpy().view(np.uint64) for i in (0, 2))
        return pa.RecordBatch.from_arrays([out.column(2), pa.array((k - x * PAIR).view(np.int64)), out.column(1)], names=["x", "w", "c"])

    def run(batches):
        counter = _Counter("k", "c", "x")
        for batch in batches:
            for c in words.chunks(batch.column(0)):
                tokens, bounds = with_ends(c)
                before = preceding(tokens, bounds)
                if repeated is not None:
                    often = in_bitmap(repeated.value, tokens) | (tokens == END)
                    both = often.copy()
                    both[1:] &= often[:-1] | (before[1:] == END)
                    before, tokens = before[both], tokens[both]
                yield from map(split, counter.add(paired(before, tokens), before))
        yield from map(split, counter.rest())

    return train.select(text_col).mapInArrow(run, "x long, w long, c long").repartition("x", "w").groupBy("x", "w").agg(F.sum("c").alias("c"))


def arcs(pairs: DataFrame, table: DataFrame, v: Vocabulary, fail: np.ndarray | None = None) -> DataFrame:
    """(x, w, c, k, nx, nw, fail): pairs with their key, the counts of both words and the context's failure weight.

    Values of the words in ``v`` are filled in by the workers, so that no frequent word is joined by
    shuffle; those of the others come from ``table``.
    """
    shipped = pairs.sparkSession.sparkContext.broadcast(pickle.dumps((v, np.zeros(len(v.hashes)) if fail is None else fail)))

    def run(batches):
        v, fail = pickle.loads(shipped.value)
        for batch in batches:
            x, w = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            at, to = v.find(x), v.find(w)
            filled = [pa.array(values[i] if len(values) else np.zeros(len(i), values.dtype), mask=i < 0) for values, i in ((v.n, at), (v.n, to), (fail, at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paired(x, w).view(np.int64)), *filled], names=["x", "w", "c", "k", "nx", "nw", "fail"])

    rows = pairs.select("x", "w", "c").mapInArrow(run, "x long, w long, c long, k long, nx long, nw long, fail double")
    names = rows.columns
    whole = F.col("nx").isNotNull() & F.col("nw").isNotNull()
    rest = rows.filter(~whole)
    of_x = table.select(F.col("w").alias("_at"), F.col("c").alias("_nx"), (F.col("fail") if "fail" in table.columns else F.lit(0.0)).alias("_fail"))
    of_w = table.select(F.col("w").alias("_at"), F.col("c").alias("_nw"))
    for key, other, values, own in (("x", "w", of_x, ("fail", "nx")), ("w", "x", of_w, ("nw",))):
        at = F.when(F.col(f"n{key}").isNull(), F.col(key)).otherwise(F.col(other))  # a held word's rows go with their rare word
        rest = rest.withColumn("_at", at).join(values, "_at").withColumns({c: F.coalesce(c, f"_{c}") for c in own}).drop("_at", *[f"_{c}" for c in own])
    return rows.filter(whole).unionByName(rest.select(*names))


class Model:
    """What workers hold of the automaton: arcs by (state, word), failure weights by state, root weights by count.

    Without ``fail`` the arcs are all that there are, and failure weights follow from them.
    """

    def __init__(self, v: Vocabulary, total: int, distinct: int, once: int, texts: int, pairs: np.ndarray, n: np.ndarray, fail: np.ndarray | None = None):
        self.v, self.total, self.distinct = v, total, distinct
        self.unknown = unknown_mass(total, once)
        order = np.argsort(pairs)
        self.arcs, n = pairs[order], n[order]
        self.find = Index(self.arcs).find
        state, word = self.arcs >> 32, self.arcs & 0xFFFFFFFF
        seen = np.append(v.n, texts).astype(float)
        p = (n - DISCOUNT) / np.maximum(seen[state], 1)
        self.arc = np.log10(p)
        if fail is None:
            left = 1 - np.bincount(state, p, len(seen))
            below = 1 - np.bincount(state, self.root_p(v.n)[word], len(seen))
            fail = np.log10(np.maximum(left, 1e-12) / np.maximum(below, 1e-12))
            fail[np.bincount(state, minlength=len(seen)) == 0] = 0.0  # no state: the token before leads to the root
        self.fail = fail
        self.root = np.log10(self.root_p(v.n))
        self.plus = np.log10(v.n + 1.0)

    def root_p(self, c: np.ndarray) -> np.ndarray:
        return (1 - self.unknown) * c / max(self.total, 1)

    def walk(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: its word's position (-1: not held here), log10 weight so far, log10(c + 1).

        The weight is that of the arc, or else of the failure arc and the root. What is not held is added later.
        """
        ids = self.v.find(tokens)
        state = contexts(ids, bounds, len(self.v.hashes))
        held = ids >= 0
        weight = np.where(state >= 0, self.fail[state], 0.0)
        weight[held] += self.root[ids[held]]
        at = self.arc_of(ids, state)
        weight[at >= 0] = self.arc[at[at >= 0]]
        return ids, weight, np.where(held, self.plus[ids] if len(self.plus) else 0.0, 0.0)

    def arc_of(self, ids: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Position of each token's arc; -1: none is held here."""
        out = np.full(len(ids), -1)
        tried = np.flatnonzero((ids >= 0) & (state >= 0))
        out[tried] = self.find((state[tried] << 32) + ids[tried])
        return out


def unknown_mass(total: int, once: int) -> float:
    return (once + 1) / (total + 2) if total else 1.0


def train_model(train: DataFrame, text_col: str) -> tuple[Model, DataFrame, DataFrame]:
    """What workers hold, the table (w, c, fail) of all words, and the table (k, gain) of all other arcs.

    ``gain`` is what a taken arc has over the failure arc and the root.
    """
    table = staged(counts(train, text_col), "counts")
    facts = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.coalesce(F.max(F.when(F.col("w") == int(END.view(np.int64)), F.col("c"))), F.lit(0)).alias("texts")).first()
    common = (F.col("c") * WORDS > facts["n"]) | (F.col("w") == int(END.view(np.int64)))
    h, n = _collect(table.filter(common), "w", "c")
    v = Vocabulary(h.view(np.uint64), n, facts["n"])
    repeated = train.sparkSession.sparkContext.broadcast(bitmap(table.filter(F.col("c") >= LEAST), "w"))
    pairs = staged(bigrams(train, text_col, repeated).filter(F.col("c") >= LEAST), "pairs")

    p = (F.col("c") - DISCOUNT) / F.col("nx")
    root = (1 - unknown_mass(facts["n"], facts["once"])) * F.col("nw") / max(facts["n"], 1)
    sums = arcs(pairs, table, v).select("x", p.alias("p"), root.alias("q")).groupBy("x").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    states = sums.select(F.col("x").alias("w"), F.log10(F.greatest(1 - F.col("p"), F.lit(1e-12)) / F.greatest(1 - F.col("q"), F.lit(1e-12))).alias("fail"))
    table = staged(table.join(states, "w", "left").select("w", "c", F.coalesce("fail", F.lit(0.0)).alias("fail")), "weights")

    h, weights = _collect(table.filter(common), "w", "fail")
    fail = np.zeros(len(v.hashes) + 1)
    fail[v.find(h.view(np.uint64))] = weights
    fail[-1] = fail[v.find(np.array([END]))[0]]  # of the start of a text
    held = F.col("c") * ARCS > facts["n"]
    x, w, c = _collect(pairs.filter(held), "x", "w", "c")
    state = np.where(x.view(np.uint64) == END, len(v.hashes), v.find(x.view(np.uint64)))
    model = Model(v, facts["n"], facts["v"], facts["once"], facts["texts"], (state << 32) + v.find(w.view(np.uint64)), c, fail)
    gains = arcs(pairs.filter(~held), table, v, fail[:-1]).select("k", (F.log10(p) - F.col("fail") - F.log10(root)).alias("gain"))
    gains = staged(gains, "gains")
    discard(pairs)
    return model, table, gains


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """Bytes of a bitmap with the low bits of all keys, 16 bits a key up to MOST_BITS; collected in pages."""
    bits = min(MOST_BITS, max(PAGE, 1 << (16 * keys.count()).bit_length()))
    slot = F.col(key).bitwiseAND(bits - 1)
    pages = keys.select(F.shiftright(slot, 15).alias("page"), slot.bitwiseAND(PAGE - 1).alias("at")).groupBy("page").agg(F.bitmap_construct_agg("at").alias("held"))
    out = np.zeros(bits >> 3, np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * (PAGE >> 3) : (r["page"] + 1) * (PAGE >> 3)] = np.frombuffer(r["held"], np.uint8)
    return out


def in_bitmap(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & np.uint64(8 * len(held) - 1)).astype(np.int64)
    return (held[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def pair_gains(rows: DataFrame, shipped, gains: DataFrame, number: int, wanted) -> DataFrame:
    """(rid, a): what the arcs that are not held add to each text in one pass."""

    def run(batches):
        m, held = pickle.loads(shipped.value), wanted.value
        for batch in batches:
            for c in words.chunks(batch.column(1)):
                tokens, bounds = with_ends(c)
                pairs = paired(preceding(tokens, bounds), tokens)
                own = np.flatnonzero(in_pass(pairs, number) & in_bitmap(held, pairs))
                ids = m.v.find(tokens)
                own = own[m.arc_of(ids[own], contexts(ids, bounds, len(m.v.hashes))[own]) < 0]
                # one row for each text and pair, with how often
                order = own[np.argsort(pairs[own], kind="stable")]
                key, doc = pairs[order], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[order]
                first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else np.empty(0, np.int64)
                times = np.diff(np.append(first, len(key)))
                often = np.zeros(len(tokens), np.int64)
                often[order[first]] = times
                at = np.flatnonzero(often)  # texts together: their ids pack well
                rid = batch.column(0).slice(c.first, c.last - c.first)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[at]
                out = pa.RecordBatch.from_arrays([rid.take(pa.array(doc)), pa.array(pairs[at].view(np.int64)), pa.array(often[at])], names=["rid", "k", "times"])
                for i in range(0, len(first), 1 << 16):
                    yield out.slice(i, 1 << 16)

    found = rows.mapInArrow(run, "rid long, k long, times long")
    gains = gains.filter(F.shiftrightunsigned("k", 32) % PASSES == number)
    return found.join(gains.hint("shuffle_hash"), "k").groupBy("rid").agg(F.sum(F.col("times") * F.col("gain")).alias("a"))


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text_col: str = "text", row_bits: int = 64) -> DataFrame:
    """Trains on the rows that are not held out and scores all: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``row_bits``: of the hash that tells rows apart at first; it changes no result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    model, table, gains = train_model(rows.filter(~F.col("held_out")), "text")
    context = docs.sparkSession.sparkContext
    automaton = (context.broadcast(pickle.dumps(model)), context.broadcast(bitmap(gains, "k")), table, gains, model)
    out, bits, seed = [], row_bits, 0
    while True:
        own = rows.withColumn("rid", F.xxhash64(F.lit(seed), "key", "text").bitwiseAND((1 << bits) - 1 if bits < 64 else -1))
        name = F.md5(F.concat_ws("/", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("text")))
        shared = own.select("rid", name.alias("name")).groupBy("rid").agg(F.min("name").alias("_a"), F.max("name").alias("_b")).filter("_a <> _b").select("rid")
        shared = staged(shared, "shared")
        if shared.isEmpty():
            return reduce(DataFrame.unionByName, [*out, traversed(own, *automaton)])
        alone = near(own, F.col("rid"), shared, F.col("rid"), hit=False).unionByName(near(own, F.col("rid"), shared, F.col("rid")).join(shared, "rid", "left_anti"))
        out.append(traversed(alone, *automaton))
        rows, bits, seed = staged(near(own, F.col("rid"), shared, F.col("rid")).join(shared, "rid", "left_semi").drop("rid"), "apart"), 64, seed + 1


def traversed(rows: DataFrame, shipped, wanted, table: DataFrame, gains: DataFrame, model: Model) -> DataFrame:
    """The result for rows (rid, key, text, held_out) of which those of one rid are alike."""

    def run(batches):
        m = pickle.loads(shipped.value)
        for batch in batches:
            for c in words.chunks(batch.column(1)):
                tokens, bounds = with_ends(c)
                ids, weight, plus = m.walk(tokens, bounds)
                n, known = np.diff(bounds), ids >= 0
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (weight, plus, known.astype(np.int64))]
                rid = batch.column(0).slice(c.first, c.last - c.first)
                none = pa.nulls(len(rid), pa.int64())
                yield pa.RecordBatch.from_arrays([rid, none, pa.array(n), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1])], names=NAMES)
                # words that are not held: one row for each text and word, with how often
                at = np.flatnonzero(~known)
                doc = np.repeat(np.arange(len(n)), n)[at]
                order = np.lexsort((tokens[at], doc))
                doc, word = doc[order], tokens[at][order]
                first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])])) if len(doc) else np.empty(0, np.int64)
                times = np.diff(np.append(first, len(doc)))
                rows = pa.RecordBatch.from_arrays([rid.take(pa.array(doc[first])), pa.array(word[first].view(np.int64)), pa.array(times), *[pa.nulls(len(first), t) for t in (pa.int64(), pa.float64(), pa.float64())]], names=NAMES)
                for i in range(0, len(first), 1 << 16):
                    yield rows.slice(i, 1 << 16)

    texts = rows.select("rid", "text")
    added = [staged(pair_gains(texts, shipped, gains, i, wanted), "added") for i in range(PASSES)]
    found = texts.mapInArrow(run, "rid long, w long, times long, known long, a double, b double")
    own = F.when(F.col("w").isNull(), 1)
    spread = F.coalesce("w", F.col("rid"))  # rows without a word go anywhere
    joined = found.withColumn("k", spread).join(table.withColumnRenamed("w", "k"), "k", "left").withColumn("c", F.when(F.col("w").isNotNull(), F.coalesce("c", F.lit(0))))
    root = F.log10(F.when(F.col("c") > 0, (1 - model.unknown) * F.col("c") / max(model.total, 1)).otherwise(F.lit(model.unknown)))
    part = joined.select(
        "rid", own.cast("long").alias("rows"), F.when(own == 1, F.col("times")).alias("n_tokens"),
        F.when(own == 1, F.col("known")).otherwise(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.when(own == 1, F.col("a")).otherwise(F.col("times") * (root + F.coalesce("fail", F.lit(0.0)))).alias("a"),
        F.when(own == 1, F.col("b")).otherwise(F.col("times") * F.log10(F.col("c") + 1)).alias("b"),
    )
    part = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), added, part)
    sums = part.groupBy("rid").agg(*[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "a", "b")])
    level = float(np.log10(model.total + model.distinct + 1))
    each = lambda c: F.col(c) / F.col("rows")  # noqa: E731  rows that repeat share their sums evenly
    ids = rows.select("rid", "key", "held_out")
    return ids.join(sums, "rid").select(
        "key", "held_out", each("n_tokens").cast("long").alias("n_tokens"), each("n_known").cast("long").alias("n_known"), F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (each("b") - each("n_tokens") * level).alias("base_score"), each("a").alias("score"),
    )


NAMES = ["rid", "w", "times", "known", "a", "b"]
