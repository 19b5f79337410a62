"""Registered queries of the text, link, grammar and entity operators.

Inputs are made from the standard tables by dictionaries and keys, the same way in Spark and in SQL;
where an operator parses text, the SQL states the fields that the text was made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import hrefs, text
from .operators import entities, pages, refine, scope
from .plans import export, star
from .queries import query

PEOPLE = ("Neal A. Maxwell", "Victor Hugo", "C. S. Lewis", "William Shakespeare", "Boyd K. Packer", "Anne Lindbergh", "Thomas S. Monson")
BOOKS = ("The Silver Lamp", "The Walk Toward Home", "Songs for a Friend", "Morning in the Clouds", "The Far Country", "The Patience of Fire")
PERIODICALS = ("Ensign", "Liahona", "Deseret News", "BYU Studies")
ARTICLES = ("Quiet Hands", "The Open Door", "A Lamp at Evening", "Bread for the Winter", "Where Rivers Meet")
CODES = (("gen", "Genesis"), ("1-ne", "1 Nephi"), ("dc", "Doctrine and Covenants"), ("matt", "Matthew"), ("alma", "Alma"))
HREFS = (
    "/study/general-conference/2002/10/rise-to-your-call?lang=eng", "/general-conference/2013/04", "/study/ensign/1980/11/x", "/study/new-era/1990/1", "/study/manual/hymns/abide",
    "/manual/childrens-songbook/love", "/study/manual/teachings-brigham-young-1997/ch1", "/study/music/x", "/scriptures/bd/aaron", "/scriptures/nt/john/3", "/study/history/saints-v1/3",
    "/history/church-in-the-west/1", "/study/broadcasts/a/b", "/study/books/mercy-for-a-day-2010/2", "/study/other/x",
)
HREF_FIELDS = (
    ("talk", "General Conference", "/general-conference/2002/10/rise-to-your-call", None), ("talk", "General Conference", None, None), ("article", "Ensign", None, None), ("article", "New Era", None, None),
    ("hymn", "Hymns", None, None), ("hymn", "Children's Songbook", None, None), ("manual", None, None, "Teachings Brigham Young"), ("hymn", "Hymns", None, None), ("study_help", "Bible Dictionary", None, None),
    ("scripture", None, None, None), ("book", None, None, "Saints, Volume 1"), ("book", None, None, "Church in the West"), ("speech", None, None, None), ("book", None, None, "Mercy for a Day"), ("other", None, None, None),
)
SPELLINGS = ("President Neal A. Maxwell", "Neal A. Maxwell", "NEAL A. MAXWELL", "Elder Neal A Maxwell", "Neal Maxwell", "Sister Hinckley", "C.S. Lewis", "Thomas S. Monson, Jr.", "by Dr. Anne Lindbergh", "Anne Lindbergh, ", "Kimball", "Paul")
KEYS = ("neal a maxwell", "neal a maxwell", "neal a maxwell", "neal a maxwell", "neal maxwell", "sister hinckley", "c s lewis", "thomas s monson", "anne lindbergh", "anne lindbergh", "kimball", "paul")


def pick(values, key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values, key: str) -> str:
    return f"({sql_list(values)})[CAST(({key}) % {len(values)} + 1 AS INT)]"


def orders(spark, sf_dir) -> DataFrame:
    return star.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))


# ---- links and keys


@query("scripture_href", f"SELECT k, {sql_pick([b for _, b in CODES], 'k')} AS book, CAST(k % 50 + 1 AS INT) AS chapter, CAST(k % 20 + 1 AS INT) AS verse_start, CAST(k % 20 + 1 + k % 3 AS INT) AS verse_end FROM (SELECT o_orderkey AS k FROM orders)", over_star=False)
def scripture_href(spark, sf_dir):
    k = F.col("k")
    verse = k % 20 + 1
    href = F.concat(F.lit("/study/scriptures/x/"), pick([c for c, _ in CODES], k), F.lit("/"), (k % 50 + 1).cast("string"), F.lit("?lang=eng&id=p"), verse.cast("string"), F.lit("%2Cp"), (verse + k % 3).cast("string"), F.lit("#p1"))
    return orders(spark, sf_dir).select("k", hrefs.scripture_href(href).alias("r")).select("k", "r.*")


@query("crossref_classify", "SELECT k, " + ", ".join(f"{sql_pick([f[i] for f in HREF_FIELDS], 'k')} AS {n}" for i, n in enumerate(("work_type", "container_title", "cited_talk_uri", "work_title_hint"))) + " FROM (SELECT o_orderkey AS k FROM orders)", over_star=False)
def crossref_classify(spark, sf_dir):
    return orders(spark, sf_dir).select("k", hrefs.crossref(pick(HREFS, F.col("k"))).alias("r")).select("k", "r.*")


@query("name_key", f"SELECT k, {sql_pick(KEYS, 'k')} AS key FROM (SELECT o_orderkey AS k FROM orders)", over_star=False)
def name_key(spark, sf_dir):
    return orders(spark, sf_dir).select("k", text.name_key(pick(SPELLINGS, F.col("k"))).alias("key"))


@query("title_key", r"SELECT p_partkey AS k, trim(regexp_replace(regexp_replace(regexp_replace(lower('The ' || p_name || ': An “Essay,” ' || p_brand || '!'), '[“”\"‘’''.,:;!?()\[\]—–-]', ' ', 'g'), '\b(the|a|an)\b', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM part", over_star=False)
def title_key(spark, sf_dir):
    part = star.table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("k"), text.title_key(F.concat(F.lit("The "), "p_name", F.lit(": An “Essay,” "), "p_brand", F.lit("!"))).alias("key"))


@query("plain_text", r"SELECT p_partkey AS k, p_name || ' of ' || p_brand || ' and ' || p_type AS plain FROM part", over_star=False)
def plain_text(spark, sf_dir):
    html = F.concat(F.lit('<p class="x">\n '), "p_name", F.lit(" <b>of</b>\t"), "p_brand", F.lit("\u00a0 <i>and "), "p_type", F.lit("</i> </p>"))
    return star.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), text.plain(html).alias("plain"))


@query("scope_select", "SELECT talk_id, year, month FROM talks WHERE year BETWEEN 1996 AND 1998 AND contains(lower(replace(session, '-', ' ')), '2 high') AND is_talk")
def scope_select(spark, sf_dir):
    refs = star.talks(spark, sf_dir).withColumns({"title": F.lit("A Talk"), "speaker": F.when(F.col("is_talk"), "S").otherwise(" "), "session": F.replace("session", F.lit("-"), F.lit(" ")), "slug": F.lit("x")})
    return scope.select(refs, "1996..1998", session="2-HIGH").select("talk_id", "year", "month")


@query("llm_cache_key", "SELECT event_id, sha256(event_type || chr(10) || right(coalesce(props, ''), 500)) AS key FROM events", over_star=False)
def llm_cache_key(spark, sf_dir):
    return star.table(spark, sf_dir, "events").select("event_id", refine.cache_key(F.col("event_type"), F.col("props")).alias("key"))


@query("llm_merge_rules", "SELECT talk_id, position, person_id, work_id, quantity, CASE WHEN w AND quantity % 2 = 1 THEN 'note' WHEN w THEN 'freetext' ELSE tier END AS tier, CASE WHEN w AND quantity % 2 = 1 THEN NULL WHEN w THEN 'R' ELSE 'old' END AS work_title, CASE WHEN w AND quantity % 2 = 1 THEN 0.9 WHEN w THEN 0.85 ELSE confidence END AS confidence FROM (SELECT *, tier IN ('freetext', 'note') AND confidence < 0.6 AND quantity % 3 > 0 AS w FROM citations)")
def llm_merge_rules(spark, sf_dir):
    c = star.citations(spark, sf_dir)
    kept = {"raw_text": F.col("quantity").cast("string"), "context": F.lit("c"), "work_title": F.lit("old"), "parser": F.lit("rules"), "year": F.lit(None).cast("int")}
    rows = c.withColumns(kept | {n: F.lit(None).cast("string") for n in ("person_quoted", "author_name", "work_type", "container_title", "locator")})

    def reader(raw: str, context: str) -> dict:
        if int(raw) % 3 == 0:
            raise ValueError("no answer")
        return {"is_citation": int(raw) % 2 == 0, "work_title": "R", "relation": "see"}

    found = refine.merged(rows, refine.answers(rows, reader))
    return found.select("talk_id", "position", "person_id", "work_id", "quantity", "tier", "work_title", "confidence")


@query("compact_citations", "SELECT t, p, r, k, x, cf FROM (SELECT talk_id AS t, person_id AS p, relation AS r, tier AS k, left(repeat('x' || quantity, 300), 600) AS x, round(confidence, 2) AS cf FROM citations WHERE tier NOT IN ('scripture', 'note'))")
def compact_citations(spark, sf_dir):
    null = F.lit(None).cast("string")
    extra = {"raw_text": F.repeat(F.concat(F.lit("x"), F.col("quantity").cast("string")), F.lit(300)), "year": F.lit(None).cast("int"), "context": null}
    rows = star.citations(spark, sf_dir).withColumns(extra | dict.fromkeys(("author_id", "locator", "work_type", "cited_talk_uri", "person_quoted", "work_title", "container_title"), null))
    return export.compact(rows).select("t", "p", "r", "k", "x", "cf")


# ---- windows that stand for inserts and updates


@query("first_wins_dedupe", "SELECT talk_id, position, min(quantity) AS quantity FROM citations GROUP BY 1, 2")
def first_wins_dedupe(spark, sf_dir):
    return first_row(star.citations(spark, sf_dir), ["talk_id", "position"], [F.col("quantity")]).select("talk_id", "position", "quantity")


@query("last_wins_dedupe", "SELECT talk_id, position, max(quantity) AS quantity FROM citations GROUP BY 1, 2")
def last_wins_dedupe(spark, sf_dir):
    return first_row(star.citations(spark, sf_dir), ["talk_id", "position"], [F.desc("quantity")]).select("talk_id", "position", "quantity")


def first_row(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key: INSERT OR IGNORE, or INSERT OR REPLACE with the order turned round."""
    from .operators.rollups import ranked

    return ranked(rows, keys, order, 1).drop("rank")


@query("prev_paragraph_context", "SELECT conv_id, turn, right(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn, text), ''), 280) AS context FROM conversations", over_star=False)
def prev_paragraph_context(spark, sf_dir):
    from pyspark.sql import Window as W

    before = F.lag("text").over(W.partitionBy("conv_id").orderBy("turn", "text"))
    return star.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.right(F.coalesce(before, F.lit("")), F.lit(pages.WIDTH)).alias("context"))


# ---- entities


def spelled(spark, sf_dir) -> DataFrame:
    """Citations with spelled names and titles, from the star."""
    k = F.col("work_id") + F.col("quantity")
    null = F.lit(None).cast("string")
    return star.citations(spark, sf_dir).select(
        "talk_id", "position", "tier", pick(SPELLINGS, k).alias("person_quoted"), null.alias("author_name"), pick(BOOKS, F.col("work_id")).alias("work_title"), F.lit("book").alias("work_type"),
        null.alias("container_title"), null.alias("cited_talk_uri"), "scripture_book",
    )


def nobody(spark) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], "speaker_name string"), spark.createDataFrame([], "canonical string, kind string, aliases array<string>")


_ID = ("neal a maxwell",) * 5 + ("marjorie pay hinckley", "c s lewis", "thomas s monson", "anne lindbergh", "anne lindbergh", "spencer w kimball", "paul")
_NAMES = f"(SELECT {sql_pick(SPELLINGS, 'work_id + quantity')} AS name, {sql_pick(_ID, 'work_id + quantity')} AS author FROM citations)"
_COMMON = f"SELECT author, name, row_number() OVER (PARTITION BY author ORDER BY n DESC, name) AS r FROM (SELECT author, name, count(*) AS n FROM {_NAMES} GROUP BY ALL)"


@query(
    "canonical_spelling",
    f"SELECT author, CASE author WHEN 'marjorie pay hinckley' THEN 'Marjorie Pay Hinckley' WHEN 'spencer w kimball' THEN 'Spencer W. Kimball' ELSE name END AS canonical_name, CASE WHEN author IN ('spencer w kimball', 'thomas s monson', 'neal a maxwell', 'marjorie pay hinckley') THEN 'church_leader' WHEN author = 'paul' THEN 'scripture_figure' ELSE 'external' END AS kind FROM ({_COMMON}) WHERE r = 1",
)
def canonical_spelling(spark, sf_dir):
    return entities.authors(spelled(spark, sf_dir), *nobody(spark))[0]


@query("author_lookup", f"SELECT talk_id, position, tier, {sql_pick(_ID, 'work_id + quantity')} AS person_id FROM citations")
def author_lookup(spark, sf_dir):
    rows = spelled(spark, sf_dir)
    return entities.with_author_ids(rows, entities.authors(rows, *nobody(spark))[1]).select("talk_id", "position", "tier", "person_id")


@query("first_last_merge", "SELECT * FROM (VALUES ('neal maxwell', 'neal a maxwell')) t(key, \"into\")", over_star=False)
def first_last_merge(spark, sf_dir):
    names = orders(spark, sf_dir).select(pick((*KEYS, "joseph smith", "joseph f smith", "mary ann lee", "mary jo lee", "mary lee", "otto von holt", "otto holt"), F.col("k")).alias("key"))
    return entities.first_last_merges(names)


@query("alias_override", f"SELECT DISTINCT name, CASE author WHEN 'anne lindbergh' THEN 'anne morrow lindbergh' ELSE author END AS author FROM {_NAMES}")
def alias_override(spark, sf_dir):
    curated = spark.createDataFrame([("Anne Morrow Lindbergh", "external", ["Anne Lindbergh"])], "canonical string, kind string, aliases array<string>")
    rows = spelled(spark, sf_dir)
    return entities.keyed_names(entities.name_counts(rows, nobody(spark)[0]), curated).select("name", "author")


@query("crossref_fill", "SELECT c.talk_id, c.position, c.person_id, c.work_id, c.quantity, coalesce(CAST(t.speaker_id AS VARCHAR), 'unknown') AS person FROM citations c LEFT JOIN talks t ON t.talk_id = c.cited_talk WHERE tier = 'crossref'")
def crossref_fill(spark, sf_dir):
    null = F.lit(None).cast("string")
    rows = star.citations(spark, sf_dir).filter("tier = 'crossref'").withColumns({"cited_talk_uri": F.col("cited_talk").cast("string"), "work_title": null, "person_quoted": null, "author_name": null})
    known = star.talks(spark, sf_dir).select(F.col("talk_id").cast("string").alias("uri"), F.lit("T").alias("title"), F.col("speaker_id").cast("string").alias("speaker_name"))
    return entities.filled(rows, known).select("talk_id", "position", "person_id", "work_id", "quantity", F.coalesce("person_quoted", F.lit("unknown")).alias("person"))


def titled(spark, sf_dir) -> DataFrame:
    """Citations with a title, spelled in two ways, and an author for some."""
    null = F.lit(None).cast("string")
    title = F.when(F.col("quantity") % 3 == 0, F.upper(pick(BOOKS, F.col("work_id")))).otherwise(pick(BOOKS, F.col("work_id")))
    return star.citations(spark, sf_dir).filter("tier in ('freetext', 'crossref')").select(
        "talk_id", "position", "tier", F.when(F.col("work_id") % 4 > 0, F.concat(F.lit("p"), (F.col("work_id") % 6).cast("string"))).alias("author_id"), F.concat(F.lit("q"), (F.col("person_id") % 5).cast("string")).alias("person_id"),
        title.alias("work_title"), F.lit("book").alias("work_type"), F.when(F.col("quantity") % 5 == 0, pick(PERIODICALS, F.col("work_id"))).alias("container_title"), null.alias("cited_talk_uri"), null.alias("scripture_book"),
    )


_LOWER = tuple(" ".join(w for w in b.lower().split() if w not in ("the", "a", "an")) for b in BOOKS)
_TITLED = f"SELECT talk_id, position, tier, CASE WHEN work_id % 4 > 0 THEN 'p' || work_id % 6 END AS author_id, 'q' || person_id % 5 AS person_id, CASE WHEN quantity % 3 = 0 THEN upper({sql_pick(BOOKS, 'work_id')}) ELSE {sql_pick(BOOKS, 'work_id')} END AS title, {sql_pick(_LOWER, 'work_id')} AS key, quantity, work_id FROM citations WHERE tier IN ('freetext', 'crossref')"
_WORKED = f"(SELECT *, CASE WHEN len(string_split(key, ' ')) >= 3 THEN 't|' || key ELSE 'a|' || key || '|' || coalesce(author_id, person_id) END AS wid FROM ({_TITLED}))"


def curated_works(spark):
    return spark.createDataFrame([], "canonical string, author string, type string, aliases array<string>")


@query("work_grouping", f"SELECT wid AS work_id, count(*) AS n, min(title) AS a_title FROM {_WORKED} GROUP BY 1")
def work_grouping(spark, sf_dir):
    spelled = entities.told_apart(entities.work_keys(titled(spark, sf_dir), curated_works(spark)), "work_id", "title")
    return spelled.groupBy("work_id").agg(F.sum("_n").alias("n"), F.min("title").alias("a_title"))


@query(
    "work_author_backfill",
    f""", w AS {_WORKED},
t AS (SELECT wid, title FROM (SELECT wid, title, row_number() OVER (PARTITION BY wid ORDER BY n DESC, title) AS r FROM (SELECT wid, title, count(*) AS n FROM w GROUP BY ALL)) WHERE r = 1),
m AS (SELECT wid, author_id FROM (SELECT wid, author_id, row_number() OVER (PARTITION BY wid ORDER BY n DESC, author_id NULLS FIRST) AS r FROM (SELECT wid, author_id, count(*) AS n FROM w GROUP BY ALL)) WHERE r = 1),
q AS (SELECT wid, person_id FROM (SELECT wid, person_id, row_number() OVER (PARTITION BY wid ORDER BY n DESC, person_id) AS r FROM (SELECT wid, person_id, count(*) AS n FROM w GROUP BY ALL)) WHERE r = 1)
SELECT wid AS work_id, title, coalesce(author_id, person_id) AS author_id FROM t JOIN m USING (wid) JOIN q USING (wid)""",
)
def work_author_backfill(spark, sf_dir):
    talks = spark.createDataFrame([], "uri string, title string, speaker_id string")
    return entities.works(entities.work_keys(titled(spark, sf_dir), curated_works(spark)), talks).select("work_id", "title", "author_id")


@query("container_resolve", "SELECT DISTINCT c.container_title, 'c|' || lower(c.container_title) AS container_id FROM (SELECT " + sql_pick(PERIODICALS, "work_id") + " AS container_title FROM citations WHERE tier IN ('freetext', 'crossref') AND quantity % 5 = 0) c")
def container_resolve(spark, sf_dir):
    return entities.containers(entities.work_keys(titled(spark, sf_dir), curated_works(spark)))[0]


_NUMBERED = (None, "12", "3–4", "Rise to Your Call", "A 1990")


@query(
    "crossref_titles",
    f"""SELECT c.talk_id, c.position, c.person_id, c.work_id, c.quantity, CASE WHEN t.talk_id IS NOT NULL AND coalesce(regexp_matches(w, '[0-9]') AND len(w) < 6, true) THEN t.title ELSE w END AS work_title
FROM (SELECT *, {sql_pick(_NUMBERED, 'work_id')} AS w FROM citations WHERE tier = 'crossref') AS c LEFT JOIN talks t ON t.talk_id = c.cited_talk""",
)
def crossref_titles(spark, sf_dir):
    """A cross-reference without a title, or with a bare number for one, takes its talk's."""
    null = F.lit(None).cast("string")
    rows = star.citations(spark, sf_dir).filter("tier = 'crossref'").withColumns({"cited_talk_uri": F.concat(F.lit("/t/"), F.col("cited_talk").cast("string")), "work_title": pick(_NUMBERED, F.col("work_id")), "person_quoted": null, "author_name": null})
    return entities.filled(rows, star.talks(spark, sf_dir)).select("talk_id", "position", "person_id", "work_id", "quantity", "work_title")


_POEMS = "SELECT talk_id, position, work_id, quantity, 'poems ' || work_id % 30 AS key, CASE WHEN quantity % 4 > 0 THEN CASE WHEN work_id % 2 = 0 THEN 'p' || work_id % 30 ELSE 'p' || quantity % 2 END END AS author FROM citations WHERE tier = 'freetext'"


@query(
    "authorless_merge",
    f""", p AS ({_POEMS}), one AS (SELECT key, min(author) AS sole FROM p WHERE author IS NOT NULL GROUP BY 1 HAVING count(DISTINCT author) = 1)
SELECT talk_id, position, p.work_id AS part, quantity, 'a|' || key || '|' || coalesce(author, sole, '') AS work_id FROM p LEFT JOIN one USING (key)""",
)
def authorless_merge(spark, sf_dir):
    """A short title without an author joins the one author under whom it is known, if there is only one."""
    null, part, q = F.lit(None).cast("string"), F.col("work_id"), F.col("quantity")
    author = F.when(q % 4 > 0, F.concat(F.lit("p"), F.when(part % 2 == 0, (part % 30).cast("string")).otherwise((q % 2).cast("string"))))
    rows = star.citations(spark, sf_dir).filter("tier = 'freetext'").select(
        "talk_id", "position", "tier", part.alias("part"), "quantity", F.concat(F.lit("Poems, "), (part % 30).cast("string")).alias("work_title"), F.lit("book").alias("work_type"), author.alias("author_id"),
        *[null.alias(c) for c in ("person_id", "container_title", "cited_talk_uri", "scripture_book")],
    )
    return entities.work_keys(rows, curated_works(spark)).select("talk_id", "position", "part", "quantity", "work_id")


_TYPES = ("book", None, "hymn", "poem", "manual")


@query(
    "untyped_works",
    f""", w AS (SELECT p_partkey AS work_id, {sql_pick(_TYPES, 'p_partkey')} AS work_type, CASE WHEN p_partkey % 7 = 0 THEN 'known' END AS author_id FROM part),
q AS (SELECT work_id, person FROM (SELECT work_id, person, row_number() OVER (PARTITION BY work_id ORDER BY n DESC, person) AS r FROM (SELECT work_id, 'q' || person_id % 9 AS person, count(*) AS n FROM citations GROUP BY ALL)) WHERE r = 1)
SELECT work_id, work_type, CASE WHEN author_id IS NULL AND work_type NOT IN ('scripture', 'periodical', 'hymn', 'manual', 'study_help') THEN person ELSE author_id END AS author_id FROM w LEFT JOIN q USING (work_id)""",
)
def untyped_works(spark, sf_dir):
    """A work without a type takes no author from those who are quoted from it: NOT IN is unknown for null."""
    key = F.col("p_partkey")
    works = star.table(spark, sf_dir, "part").select(key.alias("work_id"), pick(_TYPES, key).alias("work_type"), F.when(key % 7 == 0, "known").alias("author_id"))
    rows = star.citations(spark, sf_dir).select("work_id", F.concat(F.lit("q"), (F.col("person_id") % 9).cast("string")).alias("person_id"))
    return entities.back_filled(works, rows).select("work_id", "work_type", "author_id")


@query("speaker_ids", f"SELECT n AS uri, name AS speaker_name, id AS speaker_id FROM (SELECT unnest(range({len(SPELLINGS)})) AS n, unnest({sql_list(SPELLINGS)}) AS name, unnest({sql_list(_ID)}) AS id)", over_star=False)
def speaker_ids(spark, sf_dir):
    """Speakers are told by the aliases of their spellings."""
    talks = spark.createDataFrame(list(enumerate(SPELLINGS)), "uri long, speaker_name string").withColumn("title", F.lit("T"))
    rows = spelled(spark, sf_dir).limit(0)
    found = entities.resolve(rows, talks, nobody(spark)[1], curated_works(spark))["talks"]
    return found.select("uri", "speaker_name", "speaker_id")


@query(
    "compact_all_keys",
    f"""SELECT talk_id AS t, CASE WHEN quantity % 6 > 0 THEN person_id END AS p, CASE WHEN quantity % 4 > 0 THEN 'a' || work_id % 7 END AS a, CASE WHEN quantity % 5 > 0 THEN work_id END AS w, container_id AS c, relation AS r, tier AS k,
CAST(1900 + quantity AS INT) AS y, 'p. ' || quantity AS l, 'book' AS wt, left(repeat('x' || quantity, 400), 600) AS x, right('c' || talk_id || repeat('z', CAST(quantity * 10 AS INT)), 240) AS cx, round(confidence, 2) AS cf, '/t/' || cited_talk AS u,
CASE WHEN quantity % 6 = 0 THEN 'q' || person_id END AS pn, CASE WHEN quantity % 5 = 0 THEN CASE quantity % 3 WHEN 0 THEN 'box' ELSE {sql_pick(BOOKS, 'work_id')} END END AS wn FROM citations WHERE tier NOT IN ('scripture', 'note')""",
)
def compact_all_keys(spark, sf_dir):
    """All sixteen keys of an exported citation; an empty title counts as none."""
    q, text_of = F.col("quantity"), lambda c: F.col(c).cast("string")
    rows = star.citations(spark, sf_dir).withColumns({
        "author_id": F.when(q % 4 > 0, F.concat(F.lit("a"), (F.col("work_id") % 7).cast("string"))), "year": (q + 1900).cast("int"), "locator": F.concat(F.lit("p. "), text_of("quantity")), "work_type": F.lit("book"),
        "raw_text": F.repeat(F.concat(F.lit("x"), text_of("quantity")), F.lit(400)), "context": F.concat(F.lit("c"), text_of("talk_id"), F.repeat(F.lit("z"), q * 10)), "cited_talk_uri": F.concat(F.lit("/t/"), text_of("cited_talk")),
        "person_quoted": F.concat(F.lit("q"), text_of("person_id")), "work_title": F.when(q % 3 == 0, "").otherwise(pick(BOOKS, F.col("work_id"))), "container_title": F.lit("box"),
    })
    return export.compact(rows.withColumns({"person_id": F.when(q % 6 > 0, F.col("person_id")), "work_id": F.when(q % 5 > 0, F.col("work_id"))}))
