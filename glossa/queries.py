"""Registered queries of the citation engine, each with SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import rollups as R
from .plans import star

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, over_star: bool = True):
    """Registers a query; its SQL sees the star's views as well as the tables."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {star.SQL}{sql}" if over_star else sql
        return f

    return add


def _star(*names: str):
    return lambda spark, sf_dir: [getattr(star, n)(spark, sf_dir) for n in names]


CT, CTP = _star("citations", "talks"), _star("citations", "talks", "persons")


def entries(column: str) -> F.Column:
    """A map of text to number as 'k=v;...', which compares the same in any engine."""
    return F.array_join(F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


@query("person_by_decade", "SELECT person_id, decade, count(*) AS n FROM counted GROUP BY ALL")
def person_by_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.person_by_decade(*CT(spark, sf_dir))


@query(
    "person_leaderboard",
    "SELECT person_id, count(*) AS total, count(*) FILTER (relation <> 'see') AS quoted, count(*) FILTER (relation = 'see') AS see, count(DISTINCT talk_id) AS talks, count(DISTINCT work_id) AS works, min(year) AS first_year, max(year) AS last_year FROM counted GROUP BY 1",
)
def person_leaderboard(spark, sf_dir):
    return R.person_leaderboard(*CT(spark, sf_dir))


@query("person_decade_hist", "SELECT person_id, string_agg(decade || '=' || n, ';' ORDER BY decade) AS by_decade FROM (SELECT person_id, decade, count(*) AS n FROM counted GROUP BY ALL) GROUP BY 1")
def person_decade_hist(spark, sf_dir):
    return R.person_histogram(*CT(spark, sf_dir)).withColumn("by_decade", entries("by_decade"))


@query("speaker_leaderboard", "SELECT speaker_id, count(*) AS talks FROM talks WHERE is_talk GROUP BY 1")
def speaker_leaderboard(spark, sf_dir):
    return R.speaker_leaderboard(star.talks(spark, sf_dir))


@query("work_leaderboard", "SELECT work_id, count(*) AS total, count(DISTINCT talk_id) AS talks FROM counted GROUP BY 1")
def work_leaderboard(spark, sf_dir):
    return R.work_leaderboard(*CT(spark, sf_dir))


@query("container_distinct", "SELECT work_id, title FROM works WHERE work_id IN (SELECT container_id FROM counted)")
def container_distinct(spark, sf_dir):
    return R.containers(*CT(spark, sf_dir), star.works(spark, sf_dir))


@query(
    "scripture_rollup",
    "SELECT book, count(*) AS total, count(DISTINCT talk_id) AS talks, CASE book WHEN 'Genesis' THEN 'Old Testament' WHEN 'Isaiah' THEN 'Old Testament' WHEN 'Matthew' THEN 'New Testament' WHEN 'Alma' THEN 'Book of Mormon' WHEN 'Moroni' THEN 'Book of Mormon' WHEN 'Doctrine and Covenants' THEN 'Doctrine and Covenants' WHEN 'Moses' THEN 'Pearl of Great Price' ELSE 'Other' END AS volume FROM scr GROUP BY book",
)
def scripture_rollup(spark, sf_dir):
    return R.scripture_rollup(*CT(spark, sf_dir))


_TOP = "SELECT * FROM (SELECT book, label, n, CAST(row_number() OVER (PARTITION BY book ORDER BY n DESC, label) AS INT) AS rank FROM (SELECT book, {label} AS label, count(*) AS n FROM scr WHERE {where} GROUP BY ALL)) WHERE rank <= 10"


@query("top_chapters", _TOP.format(label="book || ' ' || chapter", where="chapter <> 0"))
def top_chapters(spark, sf_dir):
    return R.top_chapters(*CT(spark, sf_dir))


@query("top_passages", _TOP.format(label="book || ' ' || chapter || ':' || verse_start || CASE WHEN verse_end <> verse_start THEN '–' || verse_end ELSE '' END", where="chapter <> 0 AND verse_start <> 0"))
def top_passages(spark, sf_dir):
    return R.top_passages(*CT(spark, sf_dir))


ORDER = ["position", "work_id", "person_id", "quantity"]


@query(
    "talk_index",
    """, n AS (SELECT talk_id, count(*) AS counted FROM counted GROUP BY 1),
l AS (SELECT talk_id, string_agg(scripture_book || CASE WHEN chapter <> 0 THEN ' ' || chapter || CASE WHEN verse_start <> 0 THEN ':' || verse_start ELSE '' END ELSE '' END, '; ' ORDER BY position, work_id, person_id, quantity) AS s
      FROM c WHERE tier = 'scripture' AND scripture_book IS NOT NULL GROUP BY 1)
SELECT talk_id, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS conference, year, speaker_id, session, session_ord, ord, coalesce(counted, 0) AS counted, coalesce(s, '') AS scriptures
FROM talks LEFT JOIN n USING (talk_id) LEFT JOIN l USING (talk_id) WHERE is_talk""",
)
def talk_index(spark, sf_dir):
    return R.talk_index(*CT(spark, sf_dir), ORDER).withColumn("scriptures", F.array_join("scriptures", "; "))


@query(
    "conference_rollup",
    """, t AS (SELECT year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS conference, count(*) AS talks FROM talks WHERE is_talk GROUP BY 1),
n AS (SELECT conference, count(*) FILTER (tier NOT IN ('scripture', 'note')) AS citations, count(*) FILTER (tier = 'scripture') AS scripture, count(*) FILTER (tier NOT IN ('scripture', 'note') AND kind = 'external') AS external FROM c LEFT JOIN persons USING (person_id) GROUP BY 1)
SELECT conference, talks, coalesce(citations, 0) AS citations, coalesce(scripture, 0) AS scripture, coalesce(external, 0) AS external FROM t LEFT JOIN n USING (conference)""",
)
def conference_rollup(spark, sf_dir):
    return R.conference_rollup(*CTP(spark, sf_dir))


@query("conference_top_persons", "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY conference ORDER BY n DESC, person_id) AS INT) AS rank FROM (SELECT conference, person_id, count(*) AS n FROM counted GROUP BY ALL)) WHERE rank <= 6")
def conference_top_persons(spark, sf_dir):
    return R.conference_top_persons(*CT(spark, sf_dir))


@query("totals_by_tier", "SELECT tier, count(*) AS n FROM c GROUP BY 1")
def totals_by_tier(spark, sf_dir):
    return R.tiers(*CT(spark, sf_dir))


@query(
    "grand_totals",
    """SELECT (SELECT count(*) FROM talks WHERE is_talk) AS talks, count(*) AS citations, count(*) FILTER (tier NOT IN ('scripture', 'note')) AS counted, count(*) FILTER (tier = 'scripture') AS scripture,
count(DISTINCT person_id) FILTER (tier NOT IN ('scripture', 'note')) AS persons, count(DISTINCT work_id) FILTER (tier NOT IN ('scripture', 'note')) AS works, count(*) FILTER (tier NOT IN ('scripture', 'note') AND kind = 'external') AS external_citations
FROM c LEFT JOIN persons USING (person_id)""",
)
def grand_totals(spark, sf_dir):
    return R.grand_totals(*CTP(spark, sf_dir))


@query(
    "decade_totals",
    """, t AS (SELECT CAST(year // 10 * 10 AS VARCHAR) || 's' AS decade, count(*) AS talks FROM talks WHERE is_talk GROUP BY 1), n AS (SELECT decade, count(*) AS citations FROM counted GROUP BY 1)
SELECT decade, talks, coalesce(citations, 0) AS citations FROM t LEFT JOIN n USING (decade)""",
)
def decade_totals(spark, sf_dir):
    return R.decade_totals(*CT(spark, sf_dir))


_COVERAGE = "SELECT c0.year, c0.month, count(t.talk_id) AS talks_total, count(parsed_at) AS talks_parsed, count(extracted_at) AS talks_extracted FROM conferences c0 LEFT JOIN talks t ON t.year = c0.year AND t.month = c0.month AND is_talk GROUP BY 1, 2"


@query("coverage", _COVERAGE)
def coverage(spark, sf_dir):
    return R.coverage(*_star("conferences", "talks")(spark, sf_dir))


@query("status_report", f", v AS ({_COVERAGE}) SELECT v.*, (SELECT count(*) FROM citations ci JOIN talks t USING (talk_id) WHERE t.year = v.year AND t.month = v.month AND tier <> 'note') AS citations FROM v")
def status_report(spark, sf_dir):
    return R.status(*_star("conferences", "talks", "citations")(spark, sf_dir))


@query("talk_to_talk_edges", "SELECT e.talk_id, e.cited_talk, n, t.speaker_id AS cited_speaker FROM (SELECT talk_id, cited_talk, count(*) AS n FROM citations WHERE cited_talk IS NOT NULL GROUP BY ALL) e LEFT JOIN talks t ON t.talk_id = e.cited_talk")
def talk_to_talk_edges(spark, sf_dir):
    return R.talk_edges(*CT(spark, sf_dir))


@query("low_confidence", "SELECT talk_id, position, person_id, work_id, quantity FROM citations JOIN talks USING (talk_id) WHERE tier IN ('freetext', 'note') AND confidence < 0.6 AND year = 1997")
def low_confidence(spark, sf_dir):
    c, t = CT(spark, sf_dir)
    rows = c.filter(F.col("tier").isin("freetext", "note") & (F.col("confidence") < 0.6))
    return rows.join(t.filter("year = 1997").select("talk_id"), "talk_id", "left_semi").select("talk_id", "position", "person_id", "work_id", "quantity")


# ---- summaries with all their fields


@query("speaker_summary", "SELECT speaker_id, talks, name FROM (SELECT speaker_id, count(*) AS talks FROM talks WHERE is_talk GROUP BY 1) JOIN persons ON person_id = speaker_id")
def speaker_summary(spark, sf_dir):
    _, t, p = CTP(spark, sf_dir)
    return R.speaker_summary(t, p)


_HIST = "SELECT {key}, string_agg(decade || '=' || n, ';' ORDER BY decade) AS by_decade FROM (SELECT {key}, decade, count(*) AS n FROM {rows} GROUP BY ALL) GROUP BY 1"


@query(
    "work_summary",
    f""", h AS ({_HIST.format(key="work_id", rows="counted")}), n AS (SELECT work_id, count(*) AS total, count(DISTINCT talk_id) AS talks FROM counted GROUP BY 1)
SELECT work_id, total, talks, by_decade, title, work_type, author_id, name AS author FROM n JOIN h USING (work_id) LEFT JOIN works USING (work_id) LEFT JOIN persons ON person_id = author_id""",
)
def work_summary(spark, sf_dir):
    c, t, p = CTP(spark, sf_dir)
    return R.work_summary(c, t, star.works(spark, sf_dir), p).withColumn("by_decade", entries("by_decade"))


@query("scripture_summary", f", h AS ({_HIST.format(key='book', rows='scr')}), n AS (SELECT book, count(*) AS total, count(DISTINCT talk_id) AS talks FROM scr GROUP BY 1) SELECT book, total, talks, by_decade FROM n JOIN h USING (book)")
def scripture_summary(spark, sf_dir):
    return R.scripture_summary(*CT(spark, sf_dir)).withColumn("by_decade", entries("by_decade")).drop("volume")


@query("talk_summary", SQL["talk_index"].replace(f"WITH {star.SQL}", "").replace("AS scriptures\nFROM talks", "AS scriptures, uri, title, speaker_name, speaker_role\nFROM talks"))
def talk_summary(spark, sf_dir):
    return R.talk_index(*CT(spark, sf_dir), ORDER, ("uri", "title", "speaker_name", "speaker_role")).withColumn("scriptures", F.array_join("scriptures", "; "))


@query(
    "conference_summary",
    SQL["conference_rollup"].replace(f"WITH {star.SQL}", "").replace("SELECT conference, talks,", ", v AS (SELECT year, month, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS conference, count(parsed_at) AS talks_parsed, count(extracted_at) AS talks_extracted, CASE month WHEN 4 THEN 'April ' ELSE 'October ' END || year || ' general conference' AS title FROM talks WHERE is_talk GROUP BY 1, 2)\nSELECT year, month, title, talks_parsed, talks_extracted, conference, talks,").replace("LEFT JOIN n USING (conference)", "LEFT JOIN n USING (conference) JOIN v USING (conference)"),
)
def conference_summary(spark, sf_dir):
    return R.conference_summary(*CTP(spark, sf_dir))


@query("review_sample", "SELECT tier, least(25, count(*)) AS n, max(confidence) < 0.6 AS unsure FROM citations WHERE tier = 'freetext' AND confidence < 0.6 GROUP BY 1")
def review_sample(spark, sf_dir):
    """A random sample has no fixed rows: its tier, size and bound are compared."""
    found = R.sample(star.citations(spark, sf_dir), 25, "freetext", low=True, seed=1)
    return found.groupBy("tier").agg(F.count("*").alias("n"), (F.max("confidence") < 0.6).alias("unsure"))
