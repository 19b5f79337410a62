"""What keeps stages in bounds on large tables: work done once, tasks without hot keys, bounded batches."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from glossa.functions import spread
from glossa.operators import entities, fold
from glossa.operators import grammar as G

NOTES = ["<p>C. S. Lewis, Mere Christianity (1952), 174.</p>", "<p>Ibid., 180.</p>", None, "<p>Lewis, Mere Christianity, 9.</p>"]


def test_talks_of_equal_texts_share_a_fold(spark, monkeypatch):
    schema = to_arrow_schema(StructType.fromDDL(f"talk_id long, marker string, position int, {fold.CITATION}"))
    kind = to_arrow_schema(StructType.fromDDL("talk_id long, notes array<struct<inline boolean, ord int, marker string, raw_html string, context string>>"))
    talk = lambda k, texts: {"talk_id": k, "notes": [{"inline": False, "ord": i, "marker": f"{k}.{i}", "raw_html": t, "context": "c"} for i, t in enumerate(texts)]}
    talks = [talk(0, []), *[talk(k, NOTES) for k in range(1, 40)], talk(40, NOTES[1:]), {"talk_id": 41, "notes": None}]
    want = [{"talk_id": t["talk_id"], "marker": m, "position": p, **c} for t in talks for m, p, c in fold.fold((n["marker"], n["raw_html"], n["context"]) for n in t["notes"] or [])]
    calls = []
    plain = fold.Extractor.footnote
    monkeypatch.setattr(fold.Extractor, "footnote", lambda self, *a: calls.append(a) or plain(self, *a))
    folds = fold.Folds(G.DEFAULT, schema)
    batch = pa.RecordBatch.from_pylist(talks, schema=kind)
    for part in (batch, batch.slice(30)):  # the second has nothing new
        got = [r for b in fold.folded(part, schema, folds) for r in b.to_pylist()]
        assert got == [w for w in want if w["talk_id"] in part.column(0).to_pylist()]
        assert len(calls) == len(NOTES) + len(NOTES[1:])
    folds.MOST_KEPT = 0
    assert [r for b in fold.folded(batch, schema, folds) for r in b.to_pylist()] == want
    assert len(calls) == 2 * (len(NOTES) + len(NOTES[1:]))


NO_WORKS = "canonical string, author string, type string, aliases array<string>"
TEXTS = ("tier", "work_title", "work_type", "author_id", "person_id", "container_title", "cited_talk_uri", "scripture_book")


def cited(spark, *rows):
    return spark.createDataFrame([("freetext", title, "book", author, None, box, None, None) for title, author, box in rows], ", ".join(f"{c} string" for c in TEXTS))


def test_join_without_hot_keys(spark):
    """Frequent keys, rare ones, missing ones and keys that the table does not have, with and without room for all in the broadcast."""
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a"] * 300 + ["b"] * 3 + [None] * 200 + ["z", "c"])], "i int, k string")
    table = spark.createDataFrame([("a", 1, None, 300), ("b", 2, "B", 3), ("c", None, "C", 1), ("d", 4, "D", 0)], "k string, x int, y string, n int")
    want = sorted(map(str, rows.join(table, "k", "left").select("i", "k", "x", "y").collect()))
    room = spread.HEAVY
    try:
        for spread.HEAVY in (room, 1, 0):
            assert sorted(map(str, spread.attached(rows, table, "k", "n").collect())) == want
    finally:
        spread.HEAVY = room


def test_titles_are_not_joined_by_hot_keys(spark):
    """Three titles for all rows: before, each title's rows were sorted in one task."""
    rows = cited(spark, *[(t, a, None) for t in ("Poems", "Odes", "The Silver Lamp of Home") for a in ("a", "b" if t == "Odes" else "a", None)])
    rows = rows.crossJoin(spark.range(200))
    found = entities.work_keys(rows, spark.createDataFrame([], NO_WORKS))
    counts = {r["work_id"]: r["count"] for r in found.groupBy("work_id").count().collect()}
    assert counts == {"a|odes|": 200, "a|odes|a": 200, "a|odes|b": 200, "a|poems|a": 600, "t|silver lamp of home": 600}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join LeftOuter" in line]
    assert joins and not [line for line in joins if "(title_key#" in line and "Hint" not in line and "Broadcast" not in line and "strategy=broadcast" not in line]


def test_least_texts_are_found_among_distinct_ones(spark):
    """A least text is found by sorting: only distinct rows may come there."""
    rows = cited(spark, *[("Odes", "a", "Ensign"), ("Ensign", "b", None)] * 50)
    found = entities.containers(entities.work_keys(rows, spark.createDataFrame([], NO_WORKS)))[0]
    assert [tuple(r) for r in found.collect()] == [("Ensign", "a|ensign|b")]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "min(work_id" in plan
    assert "Filter (_n#" in plan


@pytest.fixture
def keys_made(spark, monkeypatch):
    """How many names had a key made."""
    made = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda name: made.add(1) or name, "string")
    plain = entities.name_key
    monkeypatch.setattr(entities, "name_key", lambda name: plain(counted(name)))
    return made


NOBODY = "canonical string, kind string, aliases array<string>"


def people(n, name):
    return F.element_at(F.array(*[F.lit(p) for p in ("Neal A. Maxwell", "Elder Neal Maxwell", "Paul")]), (F.col(n) % 3 + 1).cast("int")).alias(name)


def test_keys_are_made_of_distinct_names(spark, keys_made):
    """Before, the key of a name was made, some ten times over, for every citation."""
    rows = spark.range(3000).select(people("id", "person_quoted"), F.lit(None).cast("string").alias("author_name"))
    names = entities.name_counts(rows, spark.createDataFrame([("Paul",), ("",), (None,)], "speaker_name string"))
    found = entities.keyed_names(names, spark.createDataFrame([], NOBODY))
    assert sorted(map(tuple, found.select("name", "n", "author").collect())) == [("Elder Neal Maxwell", 1000, "neal a maxwell"), ("Neal A. Maxwell", 1000, "neal a maxwell"), ("Paul", 1000, "paul")]
    assert 0 < keys_made.value < 100


def test_keys_are_made_of_distinct_speakers(spark, keys_made):
    rows = spark.range(3).select(people("id", "person_quoted"), F.lit(None).cast("string").alias("author_name"))
    speakers = spark.range(3000).select(F.when(F.col("id") % 2 == 0, people("id", "_")).otherwise(F.when(F.col("id") % 4 == 1, "")).alias("speaker_name"))
    found = entities.authors(rows, speakers, spark.createDataFrame([], NOBODY))[0]
    assert sorted(map(tuple, found.collect())) == [("neal a maxwell", "Elder Neal Maxwell", "church_leader"), ("paul", "Paul", "church_leader")]
    assert 0 < keys_made.value < 200


def test_rows_get_ids_by_keys_of_distinct_names(spark, keys_made):
    rows = spark.range(3000).select("id", people("id", "person_quoted"), F.when(F.col("id") % 2 == 0, people("id", "_")).alias("author_name"))
    aliases = entities.authors(rows, spark.createDataFrame([], "speaker_name string"), spark.createDataFrame([], NOBODY))[1]
    found = entities.with_author_ids(rows, aliases).groupBy("author_id", "person_id").count()
    assert sorted(map(str, map(tuple, found.collect()))) == ["('neal a maxwell', 'neal a maxwell', 1000)", "('paul', 'paul', 500)", "(None, 'neal a maxwell', 1000)", "(None, 'paul', 500)"]
    assert 0 < keys_made.value < 400


@pytest.mark.parametrize("sent", [spread.SENT, 2])
def test_rows_get_ids_where_they_are(spark, monkeypatch, sent):
    """Before, all rows were moved to the tasks of their few names. With over SENT aliases only names that are not broadcast as frequent are joined by themselves."""
    monkeypatch.setattr(spread, "SENT", sent)
    monkeypatch.setattr(spread, "HEAVY", 1)
    rows = spark.range(3000).select("id", people("id", "person_quoted"), F.when(F.col("id") % 500 == 0, people("id", "_")).when(F.col("id") % 500 == 1, "nobody").alias("author_name"))
    aliases = spark.createDataFrame([("Neal A. Maxwell", "n"), ("Elder Neal Maxwell", "n"), ("Paul", "p")], "alias string, author string")
    found = entities.with_author_ids(rows, aliases)
    assert found.columns == ["id", "person_quoted", "author_name", "author_id", "person_id"]
    ids = {"Neal A. Maxwell": "n", "Elder Neal Maxwell": "n", "Paul": "p"}
    got = found.collect()
    assert sorted(r["id"] for r in got) == list(range(3000))
    assert all(r["author_id"] == ids.get(r["author_name"]) and r["person_id"] == ids[r["person_quoted"]] for r in got)
    assert {r["author_id"] for r in got} == {"n", "p", None}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line and ("[person_quoted#" in line or "[author_name#" in line)]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    if sent > 2:
        assert "SortMergeJoin" not in plan


def test_small_tables_are_at_hand(spark, monkeypatch):
    monkeypatch.setattr(spread, "SENT", 3)
    assert spread.at_hand(spark.range(4)) is None
    assert sorted(r["id"] for r in spread.at_hand(spark.range(3)).collect()) == [0, 1, 2]
    assert spread.at_hand(spark.range(0)).collect() == []


def test_segments_are_read_once(monkeypatch):
    text, made = "Bo Lee, The Lamp of Zarna (1952), 174.", []
    plain = G.Source.of
    monkeypatch.setattr(G.Source, "of", lambda *a: made.append(a) or plain(*a))
    first = G.parse(text)
    first.author = "changed"
    assert G.parse(text).author == "Bo Lee"
    assert len(made) == 1
    long = text + " " * G.REMEMBERED
    assert G.parse(long) == G.parse(long)
    assert len(made) == 3
