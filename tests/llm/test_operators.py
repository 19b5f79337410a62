"""The operators on awkward rows (nulls, empty and long texts, ties, repeats, clashing names) against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha1, sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossa.llm import decontamination, exact_dedup, minhash, mixing, scoring, secrets, sharding, substrings, toxicity, warc, words
from glossa.llm.components import components

SPACE = r"[^\x20\x09-\x0D]+"


def lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s or "")


def make_docs():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "Ünï", "é"]
    base = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(40)]
    passage = " ".join(rng.choices(vocab, k=25))
    texts = [*base, *[f"{base[3]} {passage}", f"{passage} {base[4]}", passage, passage.upper()], base[0], base[0], base[7].upper()]
    for i in range(6):  # near copies of one text
        w = base[5].split() + ["tail"] * 3 + base[6].split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [None, "", "  \t\n ", "one two", "one  TWO", "x" * 5000, " ".join(rng.choices(vocab, k=30_000))]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    return [*rows, (None, base[1], "en", "s1", 3), rows[8], (9, "another text for one id", "en", "s0", 1)]


ROWS = make_docs()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("id", "key", "node", "size", "shard", "class", "h", "part", "score", "_s")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_hashes_tell_words_and_texts_apart():
    texts = pa.array(["a b a", None, "A  b", "", "é b"])
    (c,) = list(words.chunks(texts))
    assert np.diff(c.bounds).tolist() == [3, 0, 2, 0, 2]
    h = c.hashes.tolist()
    assert h[0] == h[2] == h[3]
    assert h[1] == h[4] == h[6]
    assert len(set(h)) == 3
    assert len(words.gram_hashes(c.hashes, 2)) == 6
    assert words.inner_starts(c.bounds, 2).tolist() == [0, 1, 3, 5]
    small = [x for c in words.chunks(texts, most=1) for x in c.hashes.tolist()]
    assert small == h


def test_gram_hash_is_the_same_wherever_it_stands():
    a = next(words.chunks(pa.array(["x y z one two three four", "one two three four"])))
    g = words.gram_hashes(a.hashes, 4)
    assert g[3] == g[a.bounds[1]]
    assert g[2] != g[3]


def test_exact_dedup(spark, tmp_path):
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    for digest in (lambda n: F.sha2(n, 256), lambda n: F.substring(F.md5(n), 1, 1)):  # the second one clashes
        got = exact_dedup.exact_dedup(spark, path, digest=digest, max_bytes=1).collect()
        groups = defaultdict(list)
        for i, t, *_ in ROWS:
            groups[lower(t)].append(i)
        want = sorted((i if i is not None else -1, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)])) for i, t, *_ in ROWS)
        assert sorted((r["id"] if r["id"] is not None else -1, r["keep_id"], r["group_size"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len(groups)


def test_exact_dedup_goes_on_with_its_state(spark, tmp_path):
    """A second run reads only the files that came since, and meets the digests of the first."""
    from glossa.llm import plan

    path, state = str(tmp_path / "d [1].parquet"), str(tmp_path / "state")
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "One"), (2, "two"), (3, "three")], schema).coalesce(1).write.parquet(path)
    first = exact_dedup.exact_dedup(spark, path, state=state).collect()
    assert sorted((r["id"], r["keep_id"], r["group_size"]) for r in first) == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    spark.createDataFrame([(4, "one"), (5, "TWO"), (6, "six")], schema).coalesce(1).write.mode("append").parquet(path)
    again = exact_dedup.exact_dedup(spark, path, state=state).collect()
    assert sorted((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in again) == [(1, 4, 2, False), (2, 5, 2, False), (3, 3, 1, True), (4, 4, 2, True), (5, 5, 2, True), (6, 6, 1, True)]
    second = [b for b in spark.read.parquet(f"{state}/registry").filter("batch = 1").select("digest").collect()]
    assert len(second) == 3  # the second batch touched its own digests only
    assert plan.exists(spark, f"{state}/checkpoint")
    unread = exact_dedup.exact_dedup(spark, path, state=state).collect()  # nothing new: the state answers
    assert sorted(map(str, unread)) == sorted(map(str, again))


def test_mixture(docs, empty):
    got = mixing.mixture(docs).collect()
    size = Counter()
    for _, t, _, s, _ in ROWS:
        size[s] += len(re.findall(SPACE, t or ""))
    names = sorted((s for s in size if s), key=lambda s: s) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: 3.0 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        open_ -= over
    taken, block = Counter(), max(1, sum(size.values()) // mixing.BLOCKS)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= block + 1 for s in names)
    again = mixing.mixture(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mixture(empty).collect() == []
    mixed = mixing.apply_mixture(docs)
    assert mixed.columns == docs.columns
    blank = sum(not re.search(SPACE, t or "") for _, t, *_ in ROWS)
    assert mixed.filter(F.coalesce(F.regexp_count("text", F.lit(SPACE)), F.lit(0)) == 0).count() == blank
    shares = Counter()
    for r in got:
        assert r["taken"] == sum(x["words"] for x in r["shares"])
        for x in r["shares"]:
            shares[r["source"], x["shard"]] += x["words"]
    plan = {r["source"]: r for r in mixing.seats(mixing.targets(mixing.sized(docs).groupBy("source").agg(F.sum("size").alias("source_size")))).collect()}
    for (source, shard), n in shares.items():  # a shard holds its quota of blocks; the last one may be cut at the cap
        blocks = plan[source]["quota"] * (shard + 1) // mixing.SHARDS - plan[source]["quota"] * shard // mixing.SHARDS
        assert n <= blocks * plan[source]["block_tokens"] < n + plan[source]["block_tokens"] * 2
    quotas = mixing.shard_quotas(spark_quotas(docs), 8).groupBy("source").agg((F.max("blocks") - F.min("blocks")).alias("d")).collect()
    assert all(r["d"] <= 1 for r in quotas)


def spark_quotas(docs):
    sizes = mixing.sized(docs).groupBy("source").agg(F.sum("size").alias("source_size"))
    return mixing.seats(mixing.targets(sizes), 200)


def test_seats_are_sainte_lague(docs):
    rows = spark_quotas(docs).collect()
    target, quota, seats = {r["rank"]: r["target"] for r in rows}, Counter(), sum(r["quota"] for r in rows)
    for _ in range(seats):
        quota[max(target, key=lambda k: (target[k] / (2 * quota[k] + 1), -k))] += 1
    assert {r["rank"]: r["quota"] for r in rows} == {k: quota[k] for k in target}


def test_sharding(docs, empty):
    got = sharding.shard_rows(docs, shards=5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    parts = sharding.shard_rows(docs, shards=5, part_rows=1, bundles=1).collect()  # slots numbered in many parts
    again = defaultdict(list)
    for r in parts:
        again[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in again.values())
    small = sharding.shard_rows(docs.filter("length(text) < 3000 or text is null"), shards=3, whole=1, grain=4, keep=("lang", "size")).collect()
    assert len(small[0]) == 9
    homes = defaultdict(set)
    for r in small:
        homes[r["text_crc32"]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    assert sharding.shard_rows(empty).collect() == []


def test_shards_are_near_equal_in_all_three(spark):
    """A hot source, a large group of copies and long texts; and the packing is the plain one over the same items."""
    rng = random.Random(4)
    texts = ["copy " * 30] * 900 + [" ".join(rng.choices(["ab", "cde", "fghij"], k=rng.randint(1, 120))) for _ in range(2000)] + ["x" * 20_000, "y " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard_rows(docs, shards=8).collect()
    size, rows = Counter(), Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        rows[r["shard"]] += 1
    assert max(size.values()) <= 1.02 * min(size.values())
    assert max(rows.values()) <= 1.5 * min(rows.values())  # the shards with the long texts hold fewer rows
    items = np.array([[len(t) + 16, t.count(" ") + 1, 1] for t in texts[900:1200]])
    plain, left = [], [[1 / 5] * 3 for _ in range(5)]
    unit = items / items.sum(axis=0)
    for i in sorted(range(len(items)), key=lambda i: -max(unit[i])):
        room = [j for j in range(5) if left[j][0] >= unit[i][0]]
        j = max(room, key=lambda j: (sum(left[j][d] * unit[i][d] for d in range(3)), -j)) if room else max(range(5), key=lambda j: (left[j][0], -j))
        plain.append((i, j))
        left[j] = [left[j][d] - unit[i][d] for d in range(3)]
    assert sharding.place(items, 5).tolist() == [j for _, j in sorted(plain)]


def test_near_duplicates(docs, empty):
    got = {(r["id"], r["n_shingles"]): r for r in minhash.near_duplicates(docs).collect()}
    sets, ids = [], []
    for i, t, *_ in ROWS:
        w = re.findall(SPACE, lower(t))
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
        ids.append(i)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for x, i in enumerate(ids):
        if i is not None:
            least[find(x)].append(i)
    for x, (i, s) in enumerate(zip(ids, sets, strict=True)):
        want = min(least[find(x)], default=None) if s else i
        assert got[(i, len(s))]["component_id"] == want
    assert minhash.near_duplicates(empty).collect() == []
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns


def test_links_inside_a_bucket_are_found_by_blocks():
    rng = np.random.default_rng(1)
    whole = np.unique(rng.integers(1, 1 << 62, 400, dtype=np.int64))
    sets = [whole, np.delete(whole, slice(0, 20)), np.unique(rng.integers(1, 1 << 62, 300, dtype=np.int64))]
    packed = minhash.packed(minhash.minima([s.view(np.uint64) for s in sets]))
    codes = [c.view(np.int64).tolist() for c in packed]
    columns = {"key": [1] * 5, "node": [2, 3, 1, 2, 3], "label": [2, 3, 1, 2, 3], "stray": [True, True, False, False, False], "one": [0] * 5, "two": [0] * 5}
    order = [1, 2, 0, 1, 2]
    table = pa.table(columns | {"codes": [codes[i] for i in order], "shingles": [sets[i].tolist() for i in order]})
    assert minhash._compare(None, table).to_pylist() == [{"a": 2, "b": 1}]
    e = minhash.estimates(packed, packed)
    assert e[0, 1] == pytest.approx(0.95, abs=0.1)
    assert e[0, 2] < 0.2


def test_members_of_mixed_buckets_are_linked(spark, monkeypatch):
    rng = np.random.default_rng(4)
    whole = np.unique(rng.integers(1, 1 << 62, 300, dtype=np.int64))
    sets = {1: whole, 2: np.delete(whole, slice(0, 15)), 3: np.unique(rng.integers(1, 1 << 62, 300, dtype=np.int64)), 4: np.delete(whole, slice(20, 40))}
    codes = {n: minhash.packed(minhash.minima([s.view(np.uint64)]))[0].view(np.int64).tolist() for n, s in sets.items()}
    members = [(7, n, 1 if n == 4 else n) for n in sets] + [(8, n, 1 if n == 4 else n) for n in sets] + [(9, 1, 1), (9, 3, 3)]
    members = spark.createDataFrame([(*m, len(sets[m[1]])) for m in members], "key long, node long, label long, n long")
    nodes = spark.createDataFrame([(n, c) for n, c in codes.items()], "node long, codes array<long>")
    full = spark.createDataFrame([(n, s.tolist()) for n, s in sets.items()], "node long, shingles array<long>")
    for most in (minhash.BLOCK_BYTES, 5000):  # one block, and several
        monkeypatch.setattr(minhash, "BLOCK_BYTES", most)
        found = minhash._inside(members, nodes, full).collect()
        assert {frozenset(r) for r in found} <= {frozenset((2, 1)), frozenset((2, 4))}
        assert found


def test_estimate_stands_before_each_confirmation(spark, monkeypatch):
    """Both forms of the estimate agree, and what it rules out is not confirmed."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(1, 1 << 62, 200, dtype=np.int64))]
    sets += [np.delete(sets[0], slice(0, k)) for k in (5, 30, 90)]
    packed = minhash.packed(minhash.minima([s.view(np.uint64) for s in sets]))
    nodes = spark.createDataFrame([(i, len(s), c.view(np.int64).tolist()) for i, (s, c) in enumerate(zip(sets, packed))], "node long, n long, codes array<long>")
    pairs = spark.createDataFrame([(0, i) for i in (1, 2, 3)], "hub long, node long")
    got = pairs.join(nodes, "node").crossJoin(nodes.filter("node = 0").select(F.col("codes").alias("first"))).select("node", minhash.alike(F.col("codes"), F.col("first")).alias("e"))
    want = minhash.estimates(packed, packed)[0]
    assert all(r["e"] == pytest.approx(want[r["node"]]) for r in got.collect())
    full = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "node long, shingles array<long>")
    assert sorted(r["b"] for r in minhash.confirmed(pairs, nodes, full).collect()) == [1, 2]
    monkeypatch.setattr(minhash, "NEAR", 2.0)
    assert minhash.confirmed(pairs, nodes, full).collect() == []


def test_rows_without_id_take_part(spark):
    """A link that runs through a row without an id holds, and one id may name a copy and another text."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    far = [*base[:95], *[f"x{i}" for i in range(18)]]
    rows = [(1, " ".join(base[:90])), (None, " ".join(base)), (3, " ".join(far)), (4, "some other text that is clean"), (3, "a second text under this id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter([(1, 86, 1), (None, 96, 1), (3, 109, 1), (4, 2, 4), (3, 2, 3)])
    assert sorted((r["doc_id"], len(r["text"].split())) for r in minhash.keep_one(docs).collect()) == [(1, 90), (3, 6), (4, 6)]


def thue_morse():
    """Two words of 1,024 letters that collide under any sum of powers modulo 2 ** 64."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


def test_words_that_collide_under_polynomial_hashes(spark):
    a, b = thue_morse()
    docs = spark.createDataFrame([(1, a), (2, b), (3, " ".join([a, *map(str, range(12))])), (4, " ".join([b, *map(str, range(12))]))], "doc_id long, text string")
    assert all(r["kept"] for r in minhash.near_duplicates(docs).filter("id < 3").collect())
    assert all(r["n_removed"] == 0 for r in substrings.dedup_substrings(docs).collect())
    items = spark.createDataFrame([(7, a)], "item_id long, text string")
    assert {r["key"] for r in decontamination.scan(docs, items).filter("size(items) > 0").collect()} == {1, 3}
    got = {r["key"]: r["n_known"] for r in scoring.score(docs.filter("doc_id < 3"), F.col("doc_id") == 2).collect()}
    assert got == {1: 2, 2: 1}


def test_components(spark):
    chain = [(i, i + 1) for i in range(60, 90)] + [(1, 2), (2, 3), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 60 for i in range(60, 91)} | {1: 1, 2: 1, 3: 1, 7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_decontamination(spark, docs, empty):
    alnum = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    long_item = ROWS[40][1].split()[-20:]
    items = [(1, " ".join(long_item)), (2, "one, TWO"), (3, None), (4, ""), (None, "w1 w2"), (5, "w1"), (6, " ".join(long_item[2:14])), (7, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    for block in (10**6, 5):  # one automaton, and several
        got = decontamination.scan(docs, bench, block_tokens=block).collect()
        windows = defaultdict(set)
        for i, t in items:
            w = re.findall(alnum, lower(t))
            if w:
                k = min(10, len(w))
                for j in range(len(w) - k + 1):
                    windows[tuple(w[j : j + k])].add(None if i is None else str(i))
        want = Counter()
        for i, t, *_ in ROWS:
            w, hit, names = re.findall(alnum, lower(t)), set(), set()
            for k in {len(g) for g in windows}:
                for j in range(len(w) - k + 1):
                    if tuple(w[j : j + k]) in windows:
                        hit |= set(range(j, j + k))
                        names |= windows[tuple(w[j : j + k])]
            want[(i, len(w), len(hit), tuple(sorted(names, key=lambda x: (x is None, x))))] += 1
        assert Counter((r["key"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in got) == want
    assert decontamination.scan(empty, bench).collect() == []
    clean = decontamination.remove_spans(docs, bench)
    assert clean.columns == docs.columns
    text = lambda df: sorted(str((r["doc_id"], r["text"], r["n_chars"])) for r in df.collect())
    assert text(clean) == text(decontamination.remove_spans(docs, bench, block_tokens=5))
    assert not [r for r in decontamination.scan(clean, bench).collect() if r["items"] and r["items"] != ["2"]]
    assert decontamination.remove_spans(docs, spark.createDataFrame([], "item_id long, text string")).count() == len(ROWS)


@pytest.mark.parametrize("bits", [64, 7, 1])  # with few bits different windows share an edge, and spans fail their verification
def test_substrings(docs, empty, bits):
    out = substrings.dedup_substrings(docs, bits=bits).collect()
    texts = [(i, re.findall(SPACE, t or "")) for i, t, *_ in ROWS]
    least = {}
    for i, w in texts:
        for j in range(len(w) - 12):
            g = tuple(w[j : j + 13])
            if i is not None:
                least[g] = min(least.get(g, i), i)
    want = Counter()
    for i, w in texts:
        gone = {p for j in range(len(w) - 12) if i is not None and least[tuple(w[j : j + 13])] < i for p in range(j, j + 13)}
        want[(i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))] += 1
    assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in out) == want
    assert substrings.dedup_substrings(empty).collect() == []


def test_removal_follows_the_compacted_paths(spark, monkeypatch):
    """Without paths there are no spans to remove; a run of windows on one path is one span."""
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(20)]
    rows = [(1, " ".join([*a, *b])), (2, " ".join(["x", *a, "y"])), (3, " ".join(b)), (3, " ".join(["z", *a[:15]]))]
    docs = spark.createDataFrame(rows, "id long, text string")
    spans = substrings.path_spans(substrings.candidates(substrings.classes(docs)[0])).collect()
    assert sorted((r["id"], r["source"], r["first"] % substrings.PART, r["last"] % substrings.PART, r["at"]) for r in spans) == [(2, 1, 1, 18, 0), (3, 1, 0, 7, 30), (3, 1, 1, 3, 0)]
    assert sorted(r["n_removed"] for r in substrings.dedup_substrings(docs, key="id").collect()) == [0, 15, 20, 30]
    none = substrings.paths
    monkeypatch.setattr(substrings, "paths", lambda edges: none(edges).limit(0))
    monkeypatch.setattr(substrings, "discard", lambda *tables: None)
    assert all(r["n_removed"] == 0 for r in substrings.dedup_substrings(docs, key="id").collect())


def test_repeated_paths(spark):
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(20)]
    rows = [(1, " ".join([*a, *b])), (2, " ".join(["x", *a, "y"])), (3, " ".join(b))]
    got = substrings.repeated_paths(spark.createDataFrame(rows, "id long, text string")).collect()
    assert sorted((r["source"], r["begin"], r["words"], r["occurrences"]) for r in got) == [(1, 0, 30, 2), (1, 30, 20, 2)]


def test_scoring(docs, empty):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    got = scoring.score(docs, scoring.in_part(F.col("doc_id"), 7, 2)).collect()
    tokens = [(i, [*re.findall(SPACE, lower(t)), "\0end"]) for i, t, *_ in ROWS]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((i if i is not None else -1, held(i), len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r["key"] if r["key"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] <= 0 for r in got)
    assert scoring.score(empty, scoring.in_part(F.col("doc_id"), 7, 2)).collect() == []


def test_rows_that_share_a_hash_are_told_apart(docs):
    held = scoring.in_part(F.col("doc_id"), 7, 2)
    key = lambda r: (r["key"] if r["key"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
    want, got = (sorted(map(key, scoring.score(docs, held, row_bits=b).collect())) for b in (64, 4))
    assert got == want


def test_model_is_a_distribution():
    """Arcs, root and unknown mass of each state sum to one."""
    v = scoring.Vocabulary(np.array([5, 9, 14], np.uint64), np.array([6, 3, 3]), 12)
    m = scoring.Model(v, 12, 3, 0, 3, np.array([(0 << 32) + 1, (3 << 32) + 0]), np.array([3, 2]))
    tokens = np.array([5, 9, 14, 77], np.uint64)
    for before in (0, 1, 2, 3):
        total = 0.0
        for t in tokens:
            ids, weight, _ = m.walk(np.array([v.hashes[before], t], np.uint64) if before < 3 else np.array([t], np.uint64), np.array([0, 2 if before < 3 else 1]))
            total += 10 ** (weight[-1] + (math.log10(m.unknown) if ids[-1] < 0 else 0))
        assert total == pytest.approx(1)


def test_secrets(docs, empty):
    key, hexes = "Zx9" + "Kq7vB2m" * 3, "0123456789abcdef0"
    text = f'é password = "{key}" token: short AKIA{"A1" * 8} {hexes} api_key={"z" * 12} sEcReT:"{key}'
    base = secrets.base_spans(text, text.lower())
    kinds = Counter(k for _, k, _ in base)
    assert (kinds[0], kinds[1], kinds[2]) == (3, 1, 1)
    assert text[base[0][0] :].startswith("password")
    assert secrets.base_spans("token=secret=abcdefghijkl", "token=secret=abcdefghijkl") == [(0, 0, 25)]
    odd = "the credential was q8Zt1LwX0vR5nYb2KpM7 they said"
    assert secrets.novel_spans(odd, odd, [], secrets.Novelty()) == [(19, 3, 39)]
    plain = "the credential was application-content-type2 they said"
    assert secrets.novel_spans(plain, plain, [], secrets.Novelty()) == []
    got = secrets.scan(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["base_sha256"] == sha256(b"").hexdigest() for r in got if not (r["n_assign"] + r["n_access"] + r["n_hex"]))
    assert secrets.scan(empty).collect() == []


def test_unlabelled_secrets_are_found_and_plain_identifiers_are_not():
    """Random strings near a sensitive word, in prose, code and settings, against identifiers and words in the same places."""
    rng = random.Random(12)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = ["the secret for billing is {} as agreed", "Authorization uses bearer {} here", "def login():\n    # auth {}\n    return None", "please send the credential {} to ops", "cookie -> {} ; path=/", "{} is the private key of the host"]
    parts = "get set user account manager service handler configuration repository controller element request response builder factory context adapter session environment production settings content type".split()
    secret = ["".join(rng.choices(alphabet, k=rng.randint(20, 48))) for _ in range(300)]
    plain = ["_".join(rng.sample(parts, 3)) for _ in range(150)] + ["".join(w.title() for w in rng.sample(parts, 3)) for _ in range(150)]
    novelty = secrets.Novelty()

    def found(words):
        out = 0
        for i, w in enumerate(words):
            text = frames[i % len(frames)].format(w)
            out += any(text[a:b] == w for a, _, b in secrets.novel_spans(text, text.lower(), [], novelty))
        return out

    hits, wrong = found(secret), found(plain)
    assert hits / len(secret) >= 0.9
    assert hits / (hits + wrong) >= 0.9


def test_secret_scan_of_long_tokens_is_linear_and_lists_each_span_once():
    import time

    text = "x = AuthQ8Zt1LwX0vR5tokenYb2KpM7aZ93kLqPw end"
    spans = secrets.novel_spans(text, text.lower(), [], secrets.Novelty())
    assert len(spans) == len(set(spans)) <= 1
    text = "secret: configuration_identifier_name q8Zt1LwX0vR5nYb2KpM7"
    assert [text[a:b] for a, _, b in secrets.novel_spans(text, text.lower(), [], secrets.Novelty())] == ["q8Zt1LwX0vR5nYb2KpM7"]
    took = []
    for m in (4_000, 64_000):
        text, began = "token" * m + "1", time.perf_counter()
        secrets.base_spans(text, text)
        secrets.novel_spans(text, text, [], secrets.Novelty())
        took.append(time.perf_counter() - began)
    assert took[1] < 16 * 8 * max(took[0], 0.01)


def test_fuzzy_matches_what_edit_distance_says():
    terms = ["moron", "worthless", "scum"]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        return row[-1]

    def _next(old, i, x, b):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(old[j] + 1, new[-1] + 1, old[j - 1] + (x != y)))
        return new

    rng = random.Random(2)
    tried = ["moron", "morn", "maron", "xmoron", "moroon", "mroon", "worthles", "wrthles", "wortless", "scum", "scun", "sum", "worth", "worthlessly", "moronic"]
    tried += ["".join(rng.choice("morwthlesscu") for _ in range(rng.randint(1, 11))) for _ in range(300)]
    c = next(words.chunks(pa.array([" ".join(tried)]), words.ALNUM))
    hit = set(toxicity.Fuzzy(terms).match(c.data, c.starts, c.ends)[0].tolist())
    for i, w in enumerate(tried):
        assert (i in hit) == any(distance(w, t) <= toxicity.Fuzzy.edits(t.encode()) for t in terms), w


def test_features_and_score_against_a_plain_version():
    """Counts, window, quotation and logistic score, word by word in plain Python."""
    lexicon = toxicity.Lexicon({**dict.fromkeys(toxicity.SEED, toxicity.SEED_WEIGHT), "zogblat": 2.0}, {"grump": 1.6})
    weights = np.array([-2.0, 0.9, 0.4, 1.1, 0.3, 0.2, -0.1, 0.7])
    texts = ["you are an idiot and a zogblat", 'he said "idiot" to them', "a moroon or a grumpiness", "nothing here", "", "idiot " * 40, "they called him scum. " + "fine words " * 30 + "moron"]

    def near(w):
        return any(abs(len(w) - len(t)) <= 2 and edits(w, t) <= toxicity.Fuzzy.edits(t) for t in toxicity.SEED)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    (c,) = words.chunks(pa.array(texts), words.ALNUM)
    got = lexicon.features(c)
    for k, text in enumerate(texts):
        spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
        exact, fuzzy, stem, quoted = [], [], [], []
        for a, b in spans:
            w = lower(text)[a:b]
            weight = 2.0 if w == "zogblat" else 3.0 if w in toxicity.SEED else 0.0
            exact.append(weight)
            stem.append(1.6 if not weight and w.startswith("grump") else 0.0)
            fuzzy.append(3.0 if not weight and (near(w) or edits(w, "zogblat") <= 1) else 0.0)
            quoted.append(bool(text[:a].count('"') % 2 and '"' in text[b:]) or bool(toxicity.REPORTING.search(text[:a][-40:])) if weight or fuzzy[-1] else False)
        open_ = [0 if q else w for w, q in zip(exact, quoted)]
        every = [o + (0 if q else f) + 0.5 * s for o, q, f, s in zip(open_, quoted, fuzzy, stem)]
        window = max((sum(every[max(0, i - toxicity.SPAN + 1) : i + 1]) for i in range(len(every))), default=0)
        want = [sum(open_), sum(o > 0 for o in open_), window, sum(stem), sum(0 if q else f for f, q in zip(fuzzy, quoted)), sum(e + f for e, f, q in zip(exact, fuzzy, quoted) if q), 20 * sum(every) / (20 + len(every))]
        assert got[k].tolist() == pytest.approx([math.log1p(x) for x in want]), text
    assert (1 / (1 + np.exp(-(weights[0] + got @ weights[1:])))).shape == (len(texts),)


def test_an_id_with_several_labels_is_toxic_if_one_says_so(spark):
    docs = spark.createDataFrame([(i, f"w{i} w{i + 1}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(i, 1) for i in range(20)], "doc_id long, toxic int")
    lexicon, weights = toxicity.train_model(docs, labels, F.lit(True))
    assert weights.tolist() == toxicity.DEFAULT.tolist()  # all toxic: one class


def test_toxicity(spark, empty):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = rng.choices(vocab, k=40)
        bad = i % 4 == 0
        if bad:
            for t in rng.choices(["idiot", "moron", "moroon", "zogblat", "scum"], k=5):
                w.insert(rng.randrange(len(w)), t)
        elif i % 4 == 1:
            w.insert(5, '"idiot"')
        rows.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "w1"), (1, rows[1][1])], "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (9999, 1)], "doc_id long, toxic int")
    held = scoring.in_part(F.col("doc_id"), 3, 1)
    got = toxicity.score(docs, labels, ~held).collect()
    assert len(got) == 404
    assert all(0 <= r["score"] <= 1 for r in got)
    truth = {i: y for i, _, y in rows}
    unseen = [r for r in got if r["key"] in truth and zlib.crc32(str(r["key"]).encode()) % 3 == 1]
    assert all((r["score"] >= 0.7) == bool(truth[r["key"]]) for r in unseen)
    kept = toxicity.keep_clean(docs, labels, ~held)
    assert kept.columns == docs.columns
    assert {900, 901} <= {r["doc_id"] for r in kept.collect()}
    one_class = labels.withColumn("toxic", F.lit(0))
    assert toxicity.score(docs, one_class, ~held).count() == 404
    assert toxicity.score(empty, labels, ~held).collect() == []


def test_warc(spark, monkeypatch):
    big, tricky = "<p>é</p>" * 200, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40
    rows = [(1, "http://a/\r\n", big), (2, None, big), (3, "http://c", "small"), (4, "http://d", "small"), (5, "http://e", None), (6, "", ""), (7, "u", tricky), (8, "u", tricky), (None, "n", big), (8, "u", tricky)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"n": F.lit(1), "key": F.lit(1), "bytes": F.lit(1)})
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    top = {h: max(i for i, _, x in rows if x == h and i is not None) for h in (big, tricky)}
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = h in top and len(raw) >= 1000 and i != top[h]
        want.append((str(i), len(raw), sha1(raw).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    assert sorted(map(str, want)) == sorted(str((str(r["metadata"]["page_id"]), r["response"]["payload_bytes"], r["response"]["payload_digest"], r["response"]["type"], r["original_page"])) for r in got)
    assert all(r["request"]["concurrent_to"] == r["response"]["record_id"] == r["metadata"]["concurrent_to"] for r in got)
    assert warc.round_trip(pages.limit(0)).collect() == []
    monkeypatch.setattr(warc, "CLASSES", ((100, 2), (1650, 1), (None, 1)))  # several size classes
    again = warc.round_trip(pages).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_records_that_name_other_records(spark):
    r = lambda i, k, to=None: (i, k, to, "u", None, None, None, None, None)
    rows = [r("a", "response"), r("b", "request", "a"), r("c", "metadata", "b"), r("d", "metadata", "gone"), r("e", "request")]
    rows += [r("h", "response"), r("h0", "request", "h"), *[r(f"h{i}", "metadata", f"h{i - 1}") for i in range(1, 10)]]  # a chain of ten hops
    rows += [r("x", "request", "y"), r("y", "metadata", "x")]
    found = spark.createDataFrame(rows, warc.RECORD)
    got = {x["capture_id"]: x for x in warc.assemble(found.drop("payload")).collect()}
    assert {"a", "gone", "e", "h"} <= set(got) <= {"a", "gone", "e", "h", "x", "y"}
    assert got["a"]["metadata"]["record_id"] == "c"
    assert got["e"]["response"] is None
    assert (got["h"]["request"]["record_id"], got["h"]["metadata"]["record_id"]) == ("h0", "h9")
    assert sum(x[k] is not None for x in got.values() for k in ("request", "metadata")) >= 6


def test_malformed_archives_raise():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <m>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    assert [x[0] for x in warc.records(iter([good[:30], good[30:]]), False, True)] == ["m"]
    for bad in (good[:-3], good.replace(b": 2", b": 1")):
        with pytest.raises(ValueError, match="record"):
            list(warc.records(iter([bad]), False, True))
