"""A citation star over the standard tables, so that every summary runs on any scale of them.

Talk: orders; conference: year and half of the order date; session: priority; speaker: customer;
citation: lineitem; person: supplier; work: part; container: the part's brand. A scripture citation
takes its book, chapter and verses from the keys. ``SQL`` states the same for an SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKS = ("Genesis", "Isaiah", "Matthew", "Alma", "Moroni", "Doctrine and Covenants", "Moses", "Unlisted")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.when(F.month("o_orderdate") <= 6, 4).otherwise(10)
    day = F.dayofmonth("o_orderdate")
    at = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("talk_id"), F.year("o_orderdate").alias("year"), month.alias("month"), F.col("o_orderpriority").alias("session"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("session_ord"), day.alias("ord"), F.col("o_custkey").alias("speaker_id"), (F.col("o_orderstatus") != "P").alias("is_talk"),
        F.concat(F.lit("/t/"), F.col("o_orderkey").cast("string")).alias("uri"), F.concat(F.lit("Talk "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("Speaker "), F.col("o_custkey").cast("string")).alias("speaker_name"), F.when(F.col("o_custkey") % 3 == 0, "Of the council").alias("speaker_role"),
        F.when(F.col("o_totalprice") > 50_000, at).alias("parsed_at"), F.when(F.col("o_totalprice") > 150_000, at).alias("extracted_at"),
    )


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, p = F.col("l_quantity").cast("int"), F.col("l_partkey")
    tier = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "note").when(F.col("l_returnflag") == "R", "crossref").when(F.col("l_returnflag") == "N", "scripture").otherwise("freetext")
    book = F.try_element_at(F.array(*[F.lit(b) for b in BOOKS]), (F.pmod(p, F.lit(9)) + 1).cast("int"))
    is_scripture = tier == "scripture"
    when = lambda c: F.when(is_scripture, c)
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("talk_id"), F.col("l_linenumber").alias("position"), F.col("l_suppkey").alias("person_id"), F.col("l_partkey").alias("work_id"), tier.alias("tier"),
        F.element_at(F.array(F.lit("see"), F.lit("quoted"), F.lit("secondary")), F.pmod(q, F.lit(3)) + 1).alias("relation"), when(book).alias("scripture_book"),
        when(F.pmod(p, F.lit(40))).cast("int").alias("chapter"), when(F.pmod(F.col("l_suppkey"), F.lit(30))).cast("int").alias("verse_start"),
        when(F.pmod(F.col("l_suppkey"), F.lit(30)) + F.pmod(q, F.lit(4))).cast("int").alias("verse_end"), F.pmod(p, F.lit(25)).alias("container_id"),
        F.when(tier == "crossref", F.col("l_orderkey") + F.pmod(p, F.lit(7)) - 3).alias("cited_talk"), (F.col("l_discount") * 10).alias("confidence"), q.alias("quantity"),
    )
    return rows


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("s_nationkey") < 12, "external").when(F.col("s_nationkey") < 20, "church_leader").otherwise("scripture_figure")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name"), kind.alias("kind"))


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    author = F.when(F.col("p_partkey") % 5 > 0, F.col("p_partkey") % 200)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("work_id"), F.col("p_name").alias("title"), F.col("p_type").alias("work_type"), author.alias("author_id"))


def conferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of the talks, and one without any."""
    found = talks(spark, sf_dir).select("year", "month").distinct()
    return found.unionByName(spark.createDataFrame([(1990, 4)], "year int, month int"))


SQL = """
talks AS (SELECT o_orderkey AS talk_id, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 4 ELSE 10 END AS month, o_orderpriority AS session,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS session_ord, CAST(day(o_orderdate) AS INT) AS ord, o_custkey AS speaker_id, o_orderstatus <> 'P' AS is_talk, '/t/' || o_orderkey AS uri, 'Talk ' || o_orderkey AS title, 'Speaker ' || o_custkey AS speaker_name,
  CASE WHEN o_custkey % 3 = 0 THEN 'Of the council' END AS speaker_role,
  CASE WHEN o_totalprice > 50000 THEN 1 END AS parsed_at, CASE WHEN o_totalprice > 150000 THEN 1 END AS extracted_at FROM orders),
raw AS (SELECT *, CAST(l_quantity AS INT) AS q, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'note' WHEN l_returnflag = 'R' THEN 'crossref' WHEN l_returnflag = 'N' THEN 'scripture' ELSE 'freetext' END AS tier FROM lineitem),
citations AS (SELECT l_orderkey AS talk_id, l_linenumber AS position, l_suppkey AS person_id, l_partkey AS work_id, tier, CASE q % 3 WHEN 0 THEN 'see' WHEN 1 THEN 'quoted' ELSE 'secondary' END AS relation,
  CASE WHEN tier = 'scripture' THEN (['Genesis', 'Isaiah', 'Matthew', 'Alma', 'Moroni', 'Doctrine and Covenants', 'Moses', 'Unlisted'])[l_partkey % 9 + 1] END AS scripture_book,
  CASE WHEN tier = 'scripture' THEN l_partkey % 40 END AS chapter, CASE WHEN tier = 'scripture' THEN l_suppkey % 30 END AS verse_start, CASE WHEN tier = 'scripture' THEN l_suppkey % 30 + q % 4 END AS verse_end,
  l_partkey % 25 AS container_id, CASE WHEN tier = 'crossref' THEN l_orderkey + l_partkey % 7 - 3 END AS cited_talk, l_discount * 10 AS confidence, q AS quantity FROM raw),
persons AS (SELECT s_suppkey AS person_id, s_name AS name, CASE WHEN s_nationkey < 12 THEN 'external' WHEN s_nationkey < 20 THEN 'church_leader' ELSE 'scripture_figure' END AS kind FROM supplier),
works AS (SELECT p_partkey AS work_id, p_name AS title, p_type AS work_type, CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 200 END AS author_id FROM part),
conferences AS (SELECT DISTINCT year, month FROM talks UNION ALL SELECT 1990, 4),
c AS (SELECT citations.*, year, month, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS conference, CAST(year // 10 * 10 AS VARCHAR) || 's' AS decade FROM citations JOIN talks USING (talk_id) WHERE is_talk),
counted AS (SELECT * FROM c WHERE tier NOT IN ('scripture', 'note')),
scr AS (SELECT *, coalesce(scripture_book, '?') AS book FROM c WHERE tier = 'scripture')
"""
