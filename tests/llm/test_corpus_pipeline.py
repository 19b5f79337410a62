"""The registered queries against their SQL, and the pipeline stage by stage against the operators."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from glossa.llm import decontamination, minhash, mixing, queries, scoring, toxicity


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(name, spark, sf_dir):
    got = queries.QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    columns = got.columns
    assert sorted(columns) == sorted(want.columns)
    rows = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    near = lambda r: tuple(round(x, 3) if isinstance(x, float) else x for x in r)
    assert Counter(map(near, got.collect())) == Counter(map(near, rows))


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage leaves, as the driver hands it on."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    at = tmp_path_factory.mktemp("stages")
    for name, stage in P.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        out.append((docs, docs := spark.read.parquet(f"{at}/{name}")))
    return out


def counted(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(after.columns == list(P.COLUMNS) for _, after in stages[:-1])


def test_toxicity_stage(stages, spark, sf_dir):
    before, after = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity.score(before, labels, ~scoring.in_part(F.col("doc_id"), 3, 1))
    assert counted(scores.filter("score < 0.7"), "key") == counted(after, "doc_id")


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    kept = minhash.near_duplicates(before).filter("kept")
    assert counted(kept, "id") == counted(after, "doc_id")


def test_decontamination_stage(stages, spark, sf_dir):
    before, after = stages[2]
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {r["key"]: r for r in decontamination.scan(before, benchmark).collect()}
    left = {r["doc_id"]: r for r in after.collect()}
    for r in before.collect():
        n = sum(s["end"] - s["start"] for s in found[r["doc_id"]]["spans"])
        if not n:
            assert left[r["doc_id"]]["text"] == r["text"]
        elif n > decontamination.MOST_COVERED * found[r["doc_id"]]["n_words"]:
            assert r["doc_id"] not in left
        else:
            assert len(left[r["doc_id"]]["text"]) < len(r["text"])


def test_mixing_stage(stages):
    before, after = stages[3]
    want = {r["doc_id"]: -(-r["taken"] // r["size"]) if r["size"] else 1 for r in mixing.mixture(before).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(want)


def test_sharding_stage(stages):
    before, after = stages[4]
    assert counted(before, "doc_id", "text") == counted(after, "doc_id", "text")
    slots = Counter((r["shard"], r["slot"]) for r in after.collect())
    assert max(slots.values()) == 1


def awkward():
    from test_operators import ROWS

    return [*ROWS, (70, "idiot " * 30, "en", None, 180), (71, None, None, "s9", None), (71, None, None, "s9", None)]


@pytest.fixture(scope="module")
def awkward_dir(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("awkward")
    spark.createDataFrame([(i, i % 2) for i in range(40)] + [(70, 1), (3, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    passage = awkward()[40][1].split()[-20:]
    spark.createDataFrame([(1, " ".join(passage)), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


@pytest.mark.parametrize("n", range(5))
def test_stage_on_awkward_rows(n, spark, awkward_dir):
    """Nulls in any column, empty and long texts, ties, repeated rows and ids, and columns whose names clash."""
    from test_operators import CLASH, SCHEMA

    name, stage = P.STAGES[n]
    rows = awkward()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in (*CLASH, "id", "bucket", "item", "start", "_at", "_times", "tokens", "label")})
    got = stage(spark, docs, awkward_dir)
    if name != "sharding":
        assert got.columns == list(P.COLUMNS)
    left = Counter((r["doc_id"], r["text"]) for r in got.collect())
    blank = Counter((i, t) for i, t, *_ in rows if not (t or "").strip())
    all_rows = Counter((i, t) for i, t, *_ in rows)
    if name in ("near_duplicates", "decontamination", "mixing", "sharding"):
        assert not blank - left  # rows without words stay
    if name == "near_duplicates":
        kept = {(r["id"], r["n_shingles"]) for r in minhash.near_duplicates(docs).filter("kept").collect()}
        assert not left - all_rows
        assert {i for i, _ in left} == {i for i, _ in kept}
    if name == "decontamination":
        found = decontamination.scan(docs, spark.read.parquet(f"{awkward_dir}/benchmark.parquet"))
        clean = Counter(r["key"] for r in found.filter("size(spans) = 0").collect())
        assert not clean - Counter(i for (i, _), c in left.items() for _ in range(c))
    if name == "mixing":
        assert set(left) <= set(all_rows)
        assert max(left[x] / all_rows[x] for x in left) <= 3
    if name == "sharding":
        assert left == all_rows
        assert max(Counter((r["shard"], r["slot"]) for r in got.collect()).values()) == 1
    assert stage(spark, docs.limit(0), awkward_dir).collect() == []


def test_run_goes_through_all_stages(spark, sf_dir, stages):
    """run() gives what the stages give one after another."""
    assert counted(P.run(spark, sf_dir), "doc_id", "text") == counted(stages[-1][1], "doc_id", "text")
