"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

States are classes of item substrings; document tokens stream through the automaton, which tracks
the longest suffix that occurs in an item. A window (``window`` consecutive item words, or a whole
shorter item) occurs where the matched length reaches it; its words are hit. Tokens that no item
holds send the automaton to its root, so only runs of item vocabulary at least as long as the
shortest window are streamed; the runs are found with vector operations.

Items are read in blocks of about ``BLOCK_TOKENS`` words. Each block is one automaton, built once a
worker, and one pass over the documents; passes hand on the hits found so far, ``CHAIN`` of them in one
stage. So what the driver and a worker hold is bounded at any size of the benchmark.

Defined results: null or empty texts have no words and hit nothing; empty or null items match
nothing; items that repeat all count; items without an id hit, and count as one item without a name;
empty tables give no hits or no rows; extra columns are ignored, or passed through by ``remove_spans``.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .plan import bounded_batches, staged

WINDOW = 10
#: Words of items in one automaton (about 1 KB of worker memory each, with all states).
BLOCK_TOKENS = 200_000
#: Passes in one stage: so many automata are in memory at once on each core.
CHAIN = 3
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
#: A document is dropped where more than this share of its words is hit; else the hit spans are cut.
MOST_COVERED = 0.8


class SuffixAutomaton:
    """Of several token sequences; ``add`` extends it by one of them."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens: list[int]) -> None:
        last = 0
        for token in tokens:
            q = self.next[last].get(token)
            if q is not None:
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, token, q)
                continue
            new, p = self._state(self.len[last] + 1, {}, 0), last
            while p != -1 and token not in self.next[p]:
                self.next[p][token] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][token]
                self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, token, q)
            last = new


class Matcher:
    """The automaton of a block of items, and which windows and items its states stand for."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.vocabulary = np.unique(np.concatenate([h for _, h in items] or [np.empty(0, np.uint64)]))
        self.names = [None if i is None else str(i) for i, _ in items]
        coded = [np.searchsorted(self.vocabulary, h).tolist() for _, h in items]
        self.shortest = min([window, *(len(c) for c in coded if c)])
        self.machine = m = SuffixAutomaton()
        for c in coded:
            m.add(c)
        self.full: dict[int, set[int]] = defaultdict(set)  # state of a full window -> items
        self.short: dict[int, tuple[int, set[int]]] = {}  # state of a whole short item -> length, items
        for k, c in enumerate(coded):
            state, length = 0, 0
            for token in c:
                state, length = m.next[state][token], length + 1
                while length > window and m.len[m.link[state]] >= window:
                    state = m.link[state]
                length = min(length, window)
                if length == window:
                    self.full[state].add(k)
            if 0 < len(c) < window:
                self.short.setdefault(state, (len(c), set()))[1].add(k)
        # For each state the nearest one on its failure path, itself included, that ends a short item.
        self.ends: list[int] = [-1] * len(m.len)
        for s in sorted(range(1, len(m.len)), key=m.len.__getitem__):
            self.ends[s] = s if s in self.short else self.ends[m.link[s]]

    def stream(self, tokens: list[int], hit: np.ndarray, at: int, items: set[int]) -> None:
        """Runs tokens (all in the vocabulary) through the automaton; marks hit[at + i] and collects items."""
        m, window, ends = self.machine, self.window, self.ends
        moves, link, lens = m.next, m.link, m.len
        state = length = 0
        for i, token in enumerate(tokens):
            while state and token not in moves[state]:
                state = link[state]
                length = lens[state]
            step = moves[state].get(token)
            if step is None:
                state = length = 0
                continue
            state, length = step, length + 1
            if length >= window:  # longer matches are covered by their windows one after another
                while lens[link[state]] >= window:
                    state = link[state]
                length = window
                hit[at + i - window + 1 : at + i + 1] = True
                items |= self.full[state]
            e = ends[state]
            if e >= 0 and self.short[e][0] > length:
                e = ends[link[state]]
            while e >= 0:
                n, which = self.short[e]
                hit[at + i - n + 1 : at + i + 1] = True
                items |= which
                e = ends[link[e]]

    def scan(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Hit words of a chunk, and the items found by text."""
        hit, found = np.zeros(len(hashes), bool), {}
        if not len(self.vocabulary) or not len(hashes):
            return hit, found
        code = np.searchsorted(self.vocabulary, hashes)
        code[code == len(self.vocabulary)] = 0
        known = self.vocabulary[code] == hashes
        cut = np.zeros(len(hashes) + 1, bool)  # a run ends where a word is unknown or a text begins
        cut[bounds] = True
        edge = known.copy()
        edge[1:] = known[1:] & (~known[:-1] | cut[1:-1])
        starts = np.flatnonzero(edge)
        stop = known.copy()
        stop[:-1] = known[:-1] & (~known[1:] | cut[1:-1])
        ends = np.flatnonzero(stop) + 1
        for a, b in zip(*(x[ends - starts >= self.shortest] for x in (starts, ends)), strict=True):
            items: set[int] = set()
            self.stream(code[a:b].tolist(), hit, int(a), items)
            if items:
                found.setdefault(int(np.searchsorted(bounds, a, "right")) - 1, set()).update(items)
        return hit, found


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> Iterator[list]:
    """Lists of (id, word hashes), of about block_tokens words each, one after another."""
    block, room = [], block_tokens
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        for c in words.chunks(pa.array([row[1]], pa.string()), words.ALNUM):
            block.append((row[0], c.hashes))
            room -= len(c.hashes)
        if room <= 0:
            yield block
            block, room = [], block_tokens
    yield block


_built: dict[tuple[str, int], Matcher] = {}


def _shipped(context, block: list):
    return context.broadcast((uuid.uuid4().hex, pickle.dumps(block)))


def _matcher(shipped, window: int) -> Matcher:
    """The block's automaton; a worker keeps the one it built last."""
    name, block = shipped.value
    if (name, window) not in _built:
        _built.clear()
        _built[name, window] = Matcher(pickle.loads(block), window)
    return _built[name, window]


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(hit.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


HITS = "n_words long, spans array<struct<start: int, end: int>>, items array<string>"


def _scanned(batch: pa.RecordBatch, text_at: int, matcher: Matcher, told: bool, cut=None) -> list[pa.Array]:
    """The columns of HITS for a batch; those of earlier blocks, where told, are its last columns. ``cut`` sees each hit row."""
    n_words, spans, items = np.zeros(len(batch), np.int64), [[]] * len(batch), [[]] * len(batch)
    if told:
        spans, items = (batch.column(batch.num_columns - i).to_pylist() for i in (2, 1))
    for c in words.chunks(batch.column(text_at), words.ALNUM):
        hit, found = matcher.scan(c.hashes, c.bounds)
        n_words[c.first : c.last] = np.diff(c.bounds)
        for k in {*found, *(k for k in range(c.last - c.first) if spans[c.first + k])}:
            i, own = c.first + k, hit[c.bounds[k] : c.bounds[k + 1]]
            for s in spans[i]:
                own[s["start"] : s["end"]] = True
            names = {*items[i], *(matcher.names[x] for x in found.get(k, ()))}
            items[i] = sorted(names, key=lambda x: (x is None, x))
            spans[i] = [{"start": int(x), "end": int(y)} for x, y in zip(*_runs(own), strict=True)]
            if cut:
                cut(i, c, k, own)
    return [pa.array(n_words), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))]


def _passes(rows: DataFrame, text_col: str, benchmark: DataFrame, window: int, block_tokens: int, last) -> DataFrame:
    """All blocks but the last add to the hits of the rows; ``last`` makes the result from the rows, the last block and whether hits are told."""
    bounded_batches(rows.sparkSession)
    context, text_at, blocks = rows.sparkSession.sparkContext, rows.columns.index(text_col), item_blocks(benchmark, block_tokens=block_tokens)
    plain, block, done = rows.columns, next(blocks), 0
    kinds = ", ".join(f"`c{i}` {t}" for i, (_, t) in enumerate(rows.dtypes))
    rows = rows.toDF(*[f"c{i}" for i in range(len(plain))])
    for following in blocks:
        shipped, told = _shipped(context, block), done > 0

        def run(batches, shipped=shipped, told=told):
            for batch in batches:
                found = _scanned(batch, text_at, _matcher(shipped, window), told)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(plain)], *found], names=[*[f"c{i}" for i in range(len(plain))], "n_words", "spans", "items"])

        rows = rows.mapInArrow(run, f"{kinds}, {HITS}")
        block, done = following, done + 1
        if done % CHAIN == 0:
            rows = staged(rows, "hits")
    return last(rows, _shipped(context, block), done > 0)


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document: key, n_words, spans (hit word ranges, end exclusive), items (sorted names)."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def last(rows: DataFrame, shipped, told: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), *_scanned(batch, 1, _matcher(shipped, window), told)], names=["key", "n_words", "spans", "items"])

        return rows.mapInArrow(run, f"key {kind}, {HITS}")

    return _passes(docs.select(F.col(key).alias("key"), F.col(text_col).alias("text")), "text", benchmark, window, block_tokens, last)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: float = MOST_COVERED, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents with hit words cut out of their texts (and n_chars set anew); those covered beyond ``most`` go.

    Clean rows pass as they are, null texts too.
    """
    names, text_at, size_at = docs.columns, docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def last(rows: DataFrame, shipped, told: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                texts, keep, new = batch.column(text_at), np.ones(len(batch), bool), {}

                def cut(i, c, k, hit, texts=texts, keep=keep, new=new):
                    keep[i] = hit.mean() <= most
                    new[i] = _cut(texts[i].as_py(), c, k, hit)

                _scanned(batch, text_at, _matcher(shipped, window), told, cut)
                columns = list(batch.columns[: len(names)])
                if new:
                    columns[text_at] = pa.array([new.get(i, t) for i, t in enumerate(texts.to_pylist())], texts.type)
                    if size_at is not None:
                        sizes = columns[size_at]
                        columns[size_at] = pa.array([len(new[i]) if i in new else v for i, v in enumerate(sizes.to_pylist())], sizes.type)
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

        return rows.mapInArrow(run, docs.schema)

    return _passes(docs, "text", benchmark, window, block_tokens, last)


def n_hit(spans: str = "spans"):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]).cast("long"))


def digest(names: str = "items"):
    return F.sha2(F.array_join(F.array_sort(F.col(names)), ","), 256)


def _cut(text: str, c: words.Chunk, k: int, hit: np.ndarray) -> str:
    """The text without the bytes from the first to the last word of each hit run."""
    raw = text.encode("utf-8", "surrogatepass")
    a, base = c.bounds[k], c.offsets[k]
    out, at = [], 0
    for s, e in zip(*_runs(hit), strict=True):
        out.append(raw[at : c.starts[a + s] - base])
        at = int(c.ends[a + e - 1] - base)
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
