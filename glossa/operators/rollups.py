"""The analytical summaries: who and what is cited, by whom, when and how often.

Inputs are ``citations`` (talk_id, position, tier, relation, person_id, work_id, container_id,
scripture_book, chapter, verse_start, verse_end) and ``talks`` (talk_id, year, month, session,
session_ord, ord, speaker_id, is_talk). Summaries cover talks with is_talk only. Every ranking is
total: the count falls, then the name or id rises. All are built-in operators; aggregates are
partial before the shuffle, and top-k per group uses a ranked window that Spark limits early.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hrefs import volume_of
from ..functions.text import decade, non_blank, passage

NOT_COUNTED = ("scripture", "note")


def counted() -> Column:
    return ~F.col("tier").isin(*NOT_COUNTED)


def in_talks(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Citations of talks, with the talk's year and month."""
    return citations.join(talks.filter("is_talk").select("talk_id", "year", "month"), "talk_id")


def histogram(rows: DataFrame, keys: list[str], bucket: Column, name: str = "by_decade") -> DataFrame:
    """A sorted map of bucket -> count for each key."""
    two = rows.groupBy(*keys, bucket.alias("_b")).agg(F.count("*").alias("_n"))
    return two.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_b", "_n")))).alias(name))


def ranked(counts: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group."""
    return counts.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def totals(rows: DataFrame, key: str) -> DataFrame:
    """Per key: total, quoted, see, talks, works, first_year, last_year."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("total"), F.count_if(F.col("relation").isin("quoted", "secondary")).alias("quoted"), F.count_if(F.col("relation") == "see").alias("see"),
        F.countDistinct("talk_id").alias("talks"), F.countDistinct("work_id").alias("works"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )


def person_by_decade(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Citations of each person in each decade (conference year, not cited year)."""
    rows = in_talks(citations.filter(counted()), talks).filter("person_id is not null")
    return rows.groupBy("person_id", decade(F.col("year")).alias("decade")).agg(F.count("*").alias("n"))


def person_leaderboard(citations: DataFrame, talks: DataFrame) -> DataFrame:
    return totals(in_talks(citations.filter(counted()), talks), "person_id").orderBy(F.desc("total"), "person_id")


def person_histogram(citations: DataFrame, talks: DataFrame) -> DataFrame:
    rows = in_talks(citations.filter(counted()), talks).filter("person_id is not null")
    return histogram(rows, ["person_id"], decade(F.col("year")))


def speaker_leaderboard(talks: DataFrame) -> DataFrame:
    rows = talks.filter("is_talk and speaker_id is not null")
    return rows.groupBy("speaker_id").agg(F.count("*").alias("talks")).orderBy(F.desc("talks"), "speaker_id")


def speaker_summary(talks: DataFrame, names: DataFrame) -> DataFrame:
    """Speakers that are known, with their name; names: (person_id, name)."""
    return speaker_leaderboard(talks).join(names.select(F.col("person_id").alias("speaker_id"), "name"), "speaker_id").orderBy(F.desc("talks"), "name", "speaker_id")


def work_leaderboard(citations: DataFrame, talks: DataFrame) -> DataFrame:
    rows = in_talks(citations.filter(counted()), talks).filter("work_id is not null")
    return rows.groupBy("work_id").agg(F.count("*").alias("total"), F.countDistinct("talk_id").alias("talks")).orderBy(F.desc("total"), "work_id")


def work_summary(citations: DataFrame, talks: DataFrame, works: DataFrame, names: DataFrame) -> DataFrame:
    """Totals and decades of each work with its title, type, author and the author's name; works: (work_id, title, work_type, author_id, ...)."""
    rows = in_talks(citations.filter(counted()), talks).filter("work_id is not null")
    found = work_leaderboard(citations, talks).join(histogram(rows, ["work_id"], decade(F.col("year"))), "work_id").join(works, "work_id", "left")
    return found.join(names.select(F.col("person_id").alias("author_id"), F.col("name").alias("author")), "author_id", "left").orderBy(F.desc("total"), "title", "work_id")


def containers(citations: DataFrame, talks: DataFrame, works: DataFrame) -> DataFrame:
    """The containers that counted citations name, with titles."""
    ids = in_talks(citations.filter(counted()), talks).filter("container_id is not null").select(F.col("container_id").alias("work_id")).distinct()
    return ids.join(works.select("work_id", "title"), "work_id")


def scripture(citations: DataFrame, talks: DataFrame) -> DataFrame:
    rows = in_talks(citations.filter("tier = 'scripture'"), talks)
    return rows.withColumn("book", non_blank(F.col("scripture_book"), F.lit("?")))


def scripture_rollup(citations: DataFrame, talks: DataFrame) -> DataFrame:
    rows = scripture(citations, talks).groupBy("book").agg(F.count("*").alias("total"), F.countDistinct("talk_id").alias("talks"))
    return rows.withColumn("volume", volume_of(F.col("book"))).orderBy(F.desc("total"), "book")


def scripture_summary(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Books with their decades."""
    return scripture_rollup(citations, talks).join(histogram(scripture(citations, talks), ["book"], decade(F.col("year"))), "book").orderBy(F.desc("total"), "book")


def top_chapters(citations: DataFrame, talks: DataFrame, k: int = 10) -> DataFrame:
    rows = scripture(citations, talks).filter("chapter <> 0").withColumn("label", F.concat("book", F.lit(" "), F.col("chapter").cast("string")))
    return ranked(rows.groupBy("book", "label").agg(F.count("*").alias("n")), ["book"], [F.desc("n"), F.col("label")], k)


def top_passages(citations: DataFrame, talks: DataFrame, k: int = 10) -> DataFrame:
    rows = scripture(citations, talks).filter("chapter <> 0 and verse_start <> 0").withColumn("label", passage(*[F.col(c) for c in ("book", "chapter", "verse_start", "verse_end")]))
    return ranked(rows.groupBy("book", "label").agg(F.count("*").alias("n")), ["book"], [F.desc("n"), F.col("label")], k)


def scripture_lists(citations: DataFrame, talks: DataFrame, order: list[str]) -> DataFrame:
    """Per talk, its scripture references in order."""
    rows = in_talks(citations.filter("tier = 'scripture' and scripture_book <> ''"), talks)
    verse = F.when(F.col("verse_start") != 0, F.concat(F.lit(":"), F.col("verse_start").cast("string"))).otherwise("")
    label = F.when(F.col("chapter") != 0, F.concat("scripture_book", F.lit(" "), F.col("chapter").cast("string"), verse)).otherwise(F.col("scripture_book"))
    rows = rows.groupBy("talk_id").agg(F.array_sort(F.collect_list(F.struct(*order, label.alias("label")))).alias("_l"))
    return rows.select("talk_id", F.col("_l.label").alias("scriptures"))


def talk_index(citations: DataFrame, talks: DataFrame, order: list[str], about: tuple[str, ...] = ()) -> DataFrame:
    """One row per talk: conference, session, counted citations and scripture references, in reading order.

    ``about``: further columns of talks (address, title, speaker's name and role).
    """
    n = citations.filter(counted()).groupBy("talk_id").agg(F.count("*").alias("counted"))
    rows = talks.filter("is_talk").join(n, "talk_id", "left").join(scripture_lists(citations, talks, order), "talk_id", "left")
    rows = rows.withColumns({
        "conference": conference(), "counted": F.coalesce("counted", F.lit(0)), "session": F.coalesce("session", F.lit("")),
        "session_ord": F.coalesce("session_ord", F.lit(0)), "ord": F.coalesce("ord", F.lit(0)), "scriptures": F.coalesce("scriptures", F.array().cast("array<string>")),
    })
    return rows.select("talk_id", "conference", "year", "speaker_id", "session", "session_ord", "ord", "counted", "scriptures", *about).orderBy("conference", "session_ord", "ord", "talk_id")


def conference() -> Column:
    return F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))


def conference_rollup(citations: DataFrame, talks: DataFrame, persons: DataFrame) -> DataFrame:
    """Per conference with talks: talks, counted and scripture citations, citations of external persons."""
    heads = talks.filter("is_talk").groupBy(conference().alias("conference")).agg(F.count("*").alias("talks"))
    rows = in_talks(citations, talks).join(persons.select("person_id", "kind"), "person_id", "left")
    n = rows.groupBy(conference().alias("conference")).agg(
        F.count_if(counted()).alias("citations"), F.count_if(F.col("tier") == "scripture").alias("scripture"), F.count_if(counted() & (F.col("kind") == "external")).alias("external")
    )
    zero = {c: 0 for c in ("citations", "scripture", "external")}
    return heads.join(n, "conference", "left").fillna(zero).orderBy("conference")


def conference_title(year: str = "year", month: str = "month") -> Column:
    return F.concat(F.when(F.col(month) == 4, "April ").otherwise("October "), F.col(year).cast("string"), F.lit(" general conference"))


def conference_summary(citations: DataFrame, talks: DataFrame, persons: DataFrame) -> DataFrame:
    """The rollup with year, month, title, and how many talks are parsed and extracted."""
    heads = talks.filter("is_talk").groupBy("year", "month").agg(F.count("parsed_at").alias("talks_parsed"), F.count("extracted_at").alias("talks_extracted"))
    heads = heads.withColumns({"conference": conference(), "title": conference_title()})
    return conference_rollup(citations, talks, persons).join(heads, "conference").orderBy("conference")


def conference_top_persons(citations: DataFrame, talks: DataFrame, k: int = 6) -> DataFrame:
    rows = in_talks(citations.filter(counted()), talks).filter("person_id is not null")
    n = rows.groupBy(conference().alias("conference"), "person_id").agg(F.count("*").alias("n"))
    return ranked(n, ["conference"], [F.desc("n"), F.col("person_id")], k)


def tiers(citations: DataFrame, talks: DataFrame) -> DataFrame:
    return in_talks(citations, talks).groupBy("tier").agg(F.count("*").alias("n"))


def grand_totals(citations: DataFrame, talks: DataFrame, persons: DataFrame) -> DataFrame:
    """One row: talks, citations, counted, scripture, persons, works, external_citations."""
    rows = in_talks(citations, talks).join(persons.select("person_id", "kind"), "person_id", "left")
    n = rows.agg(
        F.count("*").alias("citations"), F.count_if(counted()).alias("counted"), F.count_if(F.col("tier") == "scripture").alias("scripture"),
        F.countDistinct(F.when(counted(), F.col("person_id"))).alias("persons"), F.countDistinct(F.when(counted(), F.col("work_id"))).alias("works"),
        F.count_if(counted() & (F.col("kind") == "external")).alias("external_citations"),
    )
    return talks.filter("is_talk").agg(F.count("*").alias("talks")).join(F.broadcast(n))  # two single rows


def decade_totals(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Decades that have talks; citations may be 0."""
    t = talks.filter("is_talk").groupBy(decade(F.col("year")).alias("decade")).agg(F.count("*").alias("talks"))
    c = in_talks(citations.filter(counted()), talks).groupBy(decade(F.col("year")).alias("decade")).agg(F.count("*").alias("citations"))
    return t.join(c, "decade", "left").fillna({"citations": 0}).orderBy("decade")


def coverage(conferences: DataFrame, talks: DataFrame) -> DataFrame:
    """Per conference, also those without talks: talks, parsed and extracted."""
    t = talks.filter("is_talk").groupBy("year", "month").agg(F.count("*").alias("talks_total"), F.count("parsed_at").alias("talks_parsed"), F.count("extracted_at").alias("talks_extracted"))
    return conferences.join(t, ["year", "month"], "left").fillna({c: 0 for c in ("talks_total", "talks_parsed", "talks_extracted")}).orderBy("year", "month")


def status(conferences: DataFrame, talks: DataFrame, citations: DataFrame) -> DataFrame:
    """Coverage with the number of citations that are not notes (scripture included, all rows of talks)."""
    n = citations.filter("tier <> 'note'").join(talks.select("talk_id", "year", "month"), "talk_id").groupBy("year", "month").agg(F.count("*").alias("citations"))
    return coverage(conferences, talks).join(n, ["year", "month"], "left").fillna({"citations": 0}).orderBy("year", "month")


def talk_edges(citations: DataFrame, talks: DataFrame) -> DataFrame:
    """Talk-to-talk citations: citing and cited talk with counts and the cited talk's speaker (null if not known)."""
    edges = citations.filter("cited_talk is not null").groupBy("talk_id", "cited_talk").agg(F.count("*").alias("n"))
    return edges.join(talks.select(F.col("talk_id").alias("cited_talk"), F.col("speaker_id").alias("cited_speaker")), "cited_talk", "left")


def aliases(names: DataFrame, key: str, alias: str, k: int = 8) -> DataFrame:
    """The first k aliases of each key in order."""
    return ranked(names.select(key, alias).distinct(), [key], [F.col(alias)], k).groupBy(key).agg(F.array_sort(F.collect_list(alias)).alias("aliases"))


def sample(citations: DataFrame, n: int, tier: str = "freetext", low: bool = False, seed: int | None = None) -> DataFrame:
    """Random citations for review: a tier or 'all' (free text and cross-references), on request only unsure ones."""
    rows = citations.filter(F.col("tier").isin("freetext", "crossref") if tier == "all" else F.col("tier") == tier)
    rows = rows.filter("confidence < 0.6") if low else rows
    return rows.orderBy(F.rand(seed)).limit(n)
