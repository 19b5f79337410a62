"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon is a seed list plus terms mined from labelled training rows (whole words and word
stems, by the lower confidence bound of their log-odds). Its fuzzy part, all terms of five letters or
more, becomes deterministic automata of BLOCK terms each: the product of the terms' trie with the
Levenshtein automaton of each term (one edit, two from eight letters on; letters are code points).
All different words of a chunk step through their tables together; most die after three letters. Hits inside quotation marks or beside a reporting verb
count apart, and the weight of the densest window of ``SPAN`` words is a feature, so that a term
that is quoted once scores below abuse. A logistic model joins the features.

Lexicon and model are fitted on at most ``TRAIN_ROWS`` labelled rows (a documented sample, by the
order of a hash of the id): 60 % of them mine terms, the others fit the model. Scoring covers every
row and whole texts. Labels, language, source and id are no features.

Defined results: null or empty text has zero features and gets the model's base score; labels that
are null, or of rows not in the table, are ignored, and an id with several labels is toxic if one of them
says so; without two classes of labels fixed weights hold; repeated rows repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .plan import bounded_batches, staged

#: Fixed seed terms.
SEED = """
idiot moron loser pathetic scum worthless stupid trash disgusting clown imbecile retard bastard asshole bitch cunt whore slut faggot
dumbass dickhead motherfucker fucker shithead bullshit scumbag lowlife degenerate parasite vermin filth subhuman dimwit halfwit
arschloch schlampe hurensohn wichser missgeburt dummkopf vollidiot abschaum drecksau
connard salope enculé ordure imbécile pourriture crétin
gilipollas cabrón hijoputa imbécil estúpido basura escoria pendejo
""".split()
REPORTING = re.compile(r"\b(?:said|says|called|calls|wrote|quote[sd]?|quoting|termed|the word|the term|sagte|nannte|a dit|appelle|dijo|llamó)\b", re.I)
TRAIN_ROWS, SPAN, SEED_WEIGHT, LEAST = 10_000, 25, 3.0, 1.5
#: Bytes on either side of a hit within which its quotation marks stand, and letters ahead of it that a reporting verb is sought in.
QUOTE_REACH, VERB_REACH = 240, 40
STEMS = (5, 7)
BLOCK = 25
#: Words that a worker remembers with their answer before it begins anew.
MET = 1 << 19
THRESHOLD = 0.7
FEATURES = 7
#: Bias and weights where the labels have one class only.
DEFAULT = np.array([-4.0, 1.0, 1.0, 1.0, 0.5, 0.5, 0.0, 1.0])


class Fuzzy:
    """One table for some terms: states are sets of (trie node, edits spent, edits allowed)."""

    def __init__(self, terms: list[str]):
        trie: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = defaultdict(list)
        self.terms = terms
        raw = [tuple(map(ord, t)) for t in terms]
        # a node's budget is the largest of the terms below it; a term checks its own at its end
        budget = [0]
        for k, t in enumerate(raw):
            node, most = 0, self.edits(t)
            budget[0] = max(budget[0], most)
            for b in t:
                if b not in trie[node]:
                    trie.append({})
                    budget.append(0)
                    trie[node][b] = len(trie) - 1
                node = trie[node][b]
                budget[node] = max(budget[node], most)
            ends[node].append(k)
        letters = sorted({b for t in raw for b in t})
        self.classes = np.zeros(max(letters, default=0) + 2, np.int64)  # 0: a letter that no term holds
        self.classes[letters] = np.arange(1, len(letters) + 1)
        symbols = [-1, *letters]

        def closed(pairs: dict[int, int]) -> frozenset:
            todo = list(pairs)
            while todo:  # deletions from the term: go on in the trie without a letter of the word
                node = todo.pop()
                for child in trie[node].values():
                    e = pairs[node] + 1
                    if e <= budget[child] and pairs.get(child, 9) > e:
                        pairs[child] = e
                        todo.append(child)
            return frozenset(pairs.items())

        def step(state: frozenset, symbol: int) -> frozenset:
            out: dict[int, int] = {}
            for node, e in state:
                if e < budget[node] and out.get(node, 9) > e + 1:
                    out[node] = e + 1  # a letter the term lacks
                for b, child in trie[node].items():
                    d = e + (b != symbol)
                    if d <= budget[child] and out.get(child, 9) > d:
                        out[child] = d
            return closed(out)

        number, order = {frozenset(): 0}, [frozenset()]
        start = closed({0: 0})
        number[start] = 1
        order.append(start)
        table, accept = [[0] * len(symbols)], [-1]
        at = 1
        while at < len(order):
            row = []
            follow = {b for node, _ in order[at] for b in trie[node]}
            other = step(order[at], -1)
            for s in symbols:
                to = step(order[at], s) if s in follow else other
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
                row.append(number[to])
            table.append(row)
            best = min(((e, k) for node, e in order[at] for k in ends.get(node, ()) if e <= self.edits(raw[k])), default=None)
            accept.append(-1 if best is None else best[1])
            at += 1
        self.table, self.accept = np.array(table, np.uint16 if len(table) < 1 << 16 else np.int32), np.array(accept, np.int32)
        self.longest = max(map(len, raw), default=0) + 2
        self.shortest = min(map(len, raw), default=0) - 2

    @staticmethod
    def edits(term) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 8 else 2

    def match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word indices, term numbers) of the words of a text in UTF-8 that some term accepts."""
        return self.walk(*letters_of(data, starts, ends))

    def walk(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts
        live = np.flatnonzero((sizes <= self.longest) & (sizes >= max(1, self.shortest)))
        letters = self.classes[np.minimum(letters.astype(np.int64), len(self.classes) - 1)]
        state = np.ones(len(live), self.table.dtype)
        found, which = [], []
        j = 0
        while len(live):
            done = sizes[live] == j
            if done.any():
                k = self.accept[state[done]]
                found.append(live[done][k >= 0])
                which.append(k[k >= 0])
                live, state = live[~done], state[~done]
            state = self.table[state, letters[starts[live] + j]]
            ok = state > 0
            live, state = live[ok], state[ok]
            j += 1
        return (np.concatenate(found), np.concatenate(which)) if found else (np.empty(0, np.int64), np.empty(0, np.int32))


def letters_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and the words' offsets in them."""
    raw = data.tobytes()
    if raw.isascii():
        return data, starts, ends
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32), at[starts], at[ends]


def fuzzy_blocks(terms: list[str]) -> list[Fuzzy]:
    """Automata that hold all terms between them; neighbours in the order of the alphabet share one."""
    terms = sorted(terms)
    return [Fuzzy(terms[i : i + BLOCK]) for i in range(0, len(terms), BLOCK)]


class Lexicon:
    def __init__(self, weights: dict[str, float], stems: dict[str, float]):
        exact = words_of(list(weights))
        order = np.argsort(exact)
        self.hashes, self.weight = exact[order], np.array(list(weights.values()))[order]
        self.met, self.met_hit = np.empty(0, np.uint64), np.empty(0, bool)
        self.fuzzy = fuzzy_blocks([*{*SEED, *[t for t in weights if len(t) >= 5]}])
        self.stems: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(s.encode()) for s in stems}:
            own = {s: w for s, w in stems.items() if len(s.encode()) == size}
            h = words_of(list(own))
            order = np.argsort(h)
            self.stems[size] = (h[order], np.array(list(own.values()))[order])

    def features(self, c: words.Chunk) -> np.ndarray:
        """FEATURES numbers for each text of the chunk."""
        n = len(c.bounds) - 1
        out = np.zeros((n, FEATURES))
        if not len(c.hashes):
            return out
        doc, count = c.doc_of_word(), np.diff(c.bounds)
        weight = _looked_up(self.hashes, self.weight, c.hashes)
        stem = np.zeros(len(c.hashes))
        for size, (h, w) in self.stems.items():
            long = np.flatnonzero(c.ends - c.starts >= size)
            stem[long] = np.maximum(stem[long], _looked_up(h, w, words.hash_spans(c.data, c.starts[long], c.starts[long] + size)))
        stem[weight > 0] = 0
        near = np.zeros(len(c.hashes))
        near[self.misspelt(c)] = SEED_WEIGHT
        near[weight > 0] = 0
        quoted = np.zeros(len(c.hashes), bool)
        hits = np.flatnonzero((weight > 0) | (near > 0))
        may_quote = {k: self.may_quote(c, int(c.offsets[k]), int(c.offsets[k + 1])) for k in np.unique(doc[hits]).tolist()}
        for i in hits[[may_quote[k] for k in doc[hits].tolist()]] if len(hits) else ():
            quoted[i] = self.is_quoted(c, int(i), int(c.offsets[doc[i]]), int(c.offsets[doc[i] + 1]))
        total = lambda x: np.bincount(doc, x, n)
        open_ = np.where(quoted, 0, weight)
        every = open_ + np.where(quoted, 0, near) + 0.5 * stem
        sums = np.concatenate([[0], np.cumsum(every)])
        left = np.maximum(c.bounds[doc], np.arange(len(doc)) - SPAN + 1)
        window = np.zeros(n)
        np.maximum.at(window, doc, sums[1:] - sums[left])
        out[:, 0] = total(open_)
        out[:, 1] = total(open_ > 0)
        out[:, 2] = window
        out[:, 3] = total(stem)
        out[:, 4] = total(np.where(quoted, 0, near))
        out[:, 5] = total(np.where(quoted, weight + near, 0))
        out[:, 6] = 20 * total(every) / (20 + count)
        return np.log1p(out)

    def misspelt(self, c: words.Chunk) -> np.ndarray:
        """Whether some automaton accepts each word. Words met before are looked up, the others walk all automata once."""
        words_, first, same = np.unique(c.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.met, words_)
        known = np.zeros(len(words_), bool)
        inside = at < len(self.met)
        known[inside] = self.met[at[inside]] == words_[inside]
        hit = np.zeros(len(words_), bool)
        hit[known] = self.met_hit[at[known]]
        new = np.flatnonzero(~known)
        letters, starts, ends = letters_of(c.data, c.starts[first[new]], c.ends[first[new]])
        sizes = ends - starts
        stops = np.cumsum(sizes)
        letters = letters[np.repeat(starts - stops + sizes, sizes) + np.arange(int(sizes.sum()))]  # of the new words only
        for fuzzy in self.fuzzy:
            hit[new[fuzzy.walk(letters, stops - sizes, stops)[0]]] = True
        if len(self.met) > MET:
            self.met, self.met_hit = words_, hit
        else:
            self.met, self.met_hit = np.insert(self.met, at[new], words_[new]), np.insert(self.met_hit, at[new], hit[new])
        return hit[same]

    @staticmethod
    def may_quote(c: words.Chunk, first: int, last: int) -> bool:
        """Whether a text has any mark or verb that is_quoted looks for."""
        text = c.data[first:last].tobytes().decode("utf-8", "ignore")
        return any(mark in text for mark in '"“„«') or bool(REPORTING.search(text))

    @staticmethod
    def is_quoted(c: words.Chunk, i: int, first: int, last: int) -> bool:
        before = c.data[max(first, c.starts[i] - QUOTE_REACH) : c.starts[i]].tobytes().decode("utf-8", "ignore")
        after = c.data[c.ends[i] : min(last, c.ends[i] + QUOTE_REACH)].tobytes().decode("utf-8", "ignore")
        for a, b in (("“", "”"), ("„", "“"), ("«", "»")):
            if before.rfind(a) > before.rfind(b) and b in after:
                return True
        line = before[before.rfind("\n") + 1 :]
        if line.count('"') % 2 == 1 and '"' in after.partition("\n")[0]:
            return True
        return bool(REPORTING.search(before[-VERB_REACH:]))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], 0.0)


def words_of(terms: list[str]) -> np.ndarray:
    """Hashes of terms as a chunk would give them."""
    raw = [t.encode() for t in terms]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64) if raw else np.empty(0, np.int64)
    return words.hash_spans(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64) if raw else ends, ends)


def mine(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words and stems: the lower bound of the log-odds of toxic against clean rows with the term."""
    facts = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    if not 0 < facts["t"] < facts["n"]:
        return {}, {}
    prior = float(np.log(facts["t"] / (facts["n"] - facts["t"])))
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)))
    cut = [F.array_distinct(F.transform(F.filter("w", lambda x, k=k: F.length(x) > k), lambda x, k=k: F.concat(F.substring(x, 1, k), F.lit("*")))) for k in STEMS]
    terms = train.select("toxic", tokens.alias("w")).select("toxic", F.explode(F.concat("w", *cut)).alias("term"))
    found = terms.groupBy("term").agg(F.sum("toxic").alias("t"), (F.count("*") - F.sum("toxic")).alias("c")).filter("t >= 2")
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    found = found.withColumn("low", F.log(t / c) - prior - 1.5 * F.sqrt(1 / t + 1 / c)).filter(F.col("low") >= LEAST)
    top = found.orderBy(F.desc("low"), "term").collect()  # of at most TRAIN_ROWS texts
    return {r["term"]: r["low"] for r in top if not r["term"].endswith("*")}, {r["term"][:-1]: r["low"] for r in top if r["term"].endswith("*")}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Bias and weights by Newton's method."""
    if not len(y) or y.min() == y.max():
        return DEFAULT
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    b[0] = np.log(y.mean() / (1 - y.mean()))
    keep = ridge * np.eye(len(b))
    keep[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ b)
        b += move
        if np.abs(move).max() < 1e-8:
            break
    return b


def _features(rows: DataFrame, lexicon, columns: str, weights: np.ndarray | None) -> DataFrame:
    """The first column with features (no weights) or the score."""
    shipped = rows.sparkSession.sparkContext.broadcast(pickle.dumps((lexicon, weights)))

    def run(batches):
        lex, b = pickle.loads(shipped.value)
        for batch in batches:
            for c in words.chunks(batch.column(1), words.ALNUM):
                x = lex.features(c)
                own = batch.column(0).slice(c.first, c.last - c.first)
                if b is None:
                    yield pa.RecordBatch.from_arrays([own, pa.array(list(x), pa.list_(pa.float64()))], names=["key", "x"])
                else:
                    p = 1 / (1 + np.exp(-np.clip(b[0] + x @ b[1:], -30, 30)))
                    yield pa.RecordBatch.from_arrays([own, pa.array(p)], names=["key", "score"])

    return rows.mapInArrow(run, columns)


def train_model(docs: DataFrame, labels: DataFrame, trainable: Column, train_rows: int = TRAIN_ROWS) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from at most ``train_rows`` labelled rows for which ``trainable`` (of doc_id) holds."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col("toxic").isNotNull() & trainable).groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(train_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("toxic", "text", F.pmod("_h", F.lit(5)).alias("part"))
    rows = staged(rows, "labelled")
    weights, stems = mine(rows.filter("part < 3"))
    lexicon = Lexicon({**dict.fromkeys(SEED, SEED_WEIGHT), **weights}, stems)
    got = _features(rows.filter("part >= 3").select("toxic", "text"), lexicon, "key int, x array<double>", None).toArrow()
    y = got["key"].to_numpy().astype(float)
    x = np.array(got["x"].to_pylist(), float).reshape(len(y), FEATURES)
    return lexicon, fit_logistic(x, y)


def score(docs: DataFrame, labels: DataFrame, trainable: Column, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key and score for every row."""
    lexicon, weights = train_model(docs, labels, trainable, train_rows)
    kind = docs.select(key).schema[0].dataType.simpleString()
    return _features(docs.select(key, text_col), lexicon, f"key {kind}, score double", weights)


def keep_clean(docs: DataFrame, labels: DataFrame, trainable: Column, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, all columns."""
    lexicon, weights = train_model(docs, labels, trainable, train_rows)
    shipped = docs.sparkSession.sparkContext.broadcast(pickle.dumps((lexicon, weights)))
    text_at = docs.columns.index("text")

    def run(batches):
        lex, b = pickle.loads(shipped.value)
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for c in words.chunks(batch.column(text_at), words.ALNUM):
                keep[c.first : c.last] = 1 / (1 + np.exp(-np.clip(b[0] + lex.features(c) @ b[1:], -30, 30))) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
