"""The stages in order: archive -> parse -> extract -> (refine) -> resolve -> summaries.

Stage tables are Parquet under one root, partitioned by year and month. A rerun over a scope replaces
the rows of the talks in scope and keeps the other talks of their conferences. Resolution and
summaries always read the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lexicon import Lexicon
from ..operators import entities, fold, pages, refine, scope
from ..operators import rollups as R
from ..sources import archive
from . import export

PARTS = ("year", "month")


def save(rows: DataFrame, path: str, scope_talks: DataFrame, key: str = "uri") -> DataFrame:
    """Puts ``rows`` in place of those of the talks in scope, and reads the whole table.

    ``scope_talks`` (key, year, month) names these talks, also those without rows. The conferences they
    are in are written aside first, with their other talks, so a run that is cut off loses nothing.
    """
    spark, aside = rows.sparkSession, f"{path}.next"
    months = [(r["year"], r["month"]) for r in scope_talks.select(*PARTS).distinct().collect()]
    known = archive.exists(spark, path)
    if known:
        old = spark.read.schema(rows.schema).parquet(path)
        there = reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in months], F.lit(False))
        rows = rows.unionByName(old.filter(there).join(scope_talks.select(key).distinct(), key, "left_anti"))
    rows.write.mode("overwrite").partitionBy(*PARTS).parquet(aside)
    new = spark.read.schema(rows.schema).parquet(aside)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)
    left = {(r["year"], r["month"]) for r in new.select(*PARTS).distinct().collect()}
    for y, m in (x for x in months if x not in left):  # conferences without any row now
        archive.delete(spark, f"{path}/year={y}/month={m}")
    archive.delete(spark, aside)
    return spark.read.schema(rows.schema).parquet(path)


def forget(spark: SparkSession, path: str, talks: DataFrame, key: str) -> None:
    """Takes the rows of some talks (uri, year, month) out of a stage table."""
    if archive.exists(spark, path):
        rows = spark.read.parquet(path)
        save(rows.limit(0), path, talks.select(F.col("uri").alias(key), *PARTS), key)


def parse(spark: SparkSession, root: str, out: str, selector: str = "all", **filters) -> DataFrame:
    """Parsed talks in scope, with paragraphs and footnotes nested; saved under ``out``/talks.

    Citations of these talks go, as they are of an older parse; and so do saved talks that the archive no longer lists.
    """
    every = archive.references(archive.tables_of_contents(spark, root))
    parsed = pages.parse_pages(scope.select(every, selector, **filters).withColumn("is_talk", scope.is_talk()), archive.contents(spark, root))
    parsed = parsed.withColumn("conference_title", R.conference_title())
    touched = scope.select(every, selector, **filters).select("uri", *PARTS)  # also those that are not cached
    if archive.exists(spark, f"{out}/talks"):
        saved = spark.read.parquet(f"{out}/talks").filter(scope.parse_selector(selector).condition())
        touched = touched.unionByName(saved.join(every, "uri", "left_anti").select("uri", *PARTS))
    touched.write.mode("overwrite").parquet(f"{out}/scope")  # it is asked for again when the talks have changed
    touched = spark.read.parquet(f"{out}/scope")
    talks = save(parsed, f"{out}/talks", touched)
    forget(spark, f"{out}/citations", touched, "talk_id")
    forget(spark, f"{out}/extracted", touched, "uri")
    archive.delete(spark, f"{out}/scope")
    return talks


def extract(spark: SparkSession, out: str, selector: str = "all", lex: Lexicon = fold.G.DEFAULT, session: str | None = None, speaker: str | None = None, include_non_talks: bool = False) -> DataFrame:
    """Citations of the saved talks in scope, with their context; saved under ``out``/citations, and when under ``out``/extracted."""
    talks = spark.read.parquet(f"{out}/talks").filter(scope.parse_selector(selector).condition()).withColumn("speaker", F.col("speaker_name"))
    talks = scope.narrowed(talks, session, speaker, include_non_talks, F.col("is_talk"))
    notes = pages.footnotes(talks)
    found = fold.extract(notes, lex).withColumnRenamed("year", "cited_year")
    found = found.join(notes.select("talk_id", "marker", "context"), ["talk_id", "marker"]).join(talks.select(F.col("uri").alias("talk_id"), *PARTS), "talk_id")
    citations = save(found, f"{out}/citations", talks.select(F.col("uri").alias("talk_id"), *PARTS), "talk_id")
    save(talks.select("uri", F.current_timestamp().alias("extracted_at"), *PARTS), f"{out}/extracted", talks.select("uri", *PARTS))
    return citations


def dated_talks(spark: SparkSession, out: str) -> DataFrame:
    """The saved talks, with talk_id and when they were extracted."""
    talks = spark.read.parquet(f"{out}/talks").withColumn("talk_id", F.col("uri"))
    if not archive.exists(spark, f"{out}/extracted"):
        return talks.withColumn("extracted_at", F.lit(None).cast("timestamp"))
    return talks.join(spark.read.parquet(f"{out}/extracted").select("uri", "extracted_at"), "uri", "left")


def coverage(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Per conference of the archive: talks, parsed and extracted."""
    return R.coverage(archive.tables_of_contents(spark, root).select("year", "month"), dated_talks(spark, out))


def refined(spark: SparkSession, out: str, reader: Callable[[str, str], dict], cache: DataFrame | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{out}/citations").withColumnRenamed("year", "_year").withColumnRenamed("cited_year", "year")
    return refine.merged(rows, refine.answers(rows, reader, cache)).withColumnRenamed("year", "cited_year").withColumnRenamed("_year", "year")


def resolve(spark: SparkSession, out: str, overrides: str | None = None, citations: DataFrame | None = None) -> dict[str, DataFrame]:
    rows = citations if citations is not None else spark.read.parquet(f"{out}/citations")
    rows = rows.drop(*PARTS).withColumnRenamed("cited_year", "year")
    return entities.resolve(rows, dated_talks(spark, out).drop("talk_id"), *archive.overrides(spark, overrides))


def resolved(spark: SparkSession, out: str, overrides: str | None = None, citations: DataFrame | None = None) -> dict[str, DataFrame]:
    """The resolved tables, saved under ``out``/resolved and read again, so that each summary starts from them."""
    for name, rows in resolve(spark, out, overrides, citations).items():
        rows.write.mode("overwrite").parquet(f"{out}/resolved/{name}")
    return {n: spark.read.parquet(f"{out}/resolved/{n}") for n in ("authors", "aliases", "works", "talks", "citations")}


def summaries(found: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every summary of the resolved tables."""
    talks = found["talks"].withColumn("talk_id", F.col("uri"))
    citations = found["citations"].drop("year", "month")
    names = found["authors"].select(F.col("author").alias("person_id"), F.col("canonical_name").alias("name"), "kind")
    persons = R.person_leaderboard(citations, talks).join(R.person_histogram(citations, talks), "person_id")
    persons = persons.join(names, "person_id", "left").join(R.aliases(found["aliases"].withColumnRenamed("author", "person_id"), "person_id", "alias"), "person_id", "left")
    spelled = found["citations"].select("work_id", F.coalesce("work_title", "container_title").alias("alias")).filter("work_id is not null and alias is not null")
    works = R.work_summary(citations, talks, found["works"], names).join(R.aliases(spelled, "work_id", "alias", 6), "work_id", "left")
    order = ["marker", "position"]
    return {
        "persons": persons.orderBy(F.desc("total"), "name"), "works": works.orderBy(F.desc("total"), "title"), "speakers": R.speaker_summary(talks, names),
        "scripture": R.scripture_summary(citations, talks), "chapters": R.top_chapters(citations, talks), "passages": R.top_passages(citations, talks),
        "talks": R.talk_index(citations, talks, order, ("uri", "title", "speaker_name", "speaker_role")),
        "conferences": R.conference_summary(citations, talks, names), "conference_persons": R.conference_top_persons(citations, talks).join(names.select("person_id", "name"), "person_id", "left"),
        "tiers": R.tiers(citations, talks), "totals": R.grand_totals(citations, talks, names), "decades": R.decade_totals(citations, talks), "containers": R.containers(citations, talks, found["works"]),
    }


def run(spark: SparkSession, root: str, out: str, selector: str = "all", overrides: str | None = None, reader: Callable[[str, str], dict] | None = None, **filters) -> dict[str, DataFrame]:
    """All stages; writes the site under ``out``/site and gives the summaries."""
    parse(spark, root, out, selector, **filters)
    extract(spark, out, selector, **filters)
    found = resolved(spark, out, overrides, refined(spark, out, reader) if reader else None)
    tables = summaries(found)
    export.write_site(tables, found["citations"], f"{out}/site")
    return tables
